import re
from collections import Counter

from arrears.llm import quality_rules as q

from .conftest import documents, prose


def expected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_equal_brute_force(spark, odd):
    texts = ["a b c a b c", "x\nx\n \nx y", "a b a b a b a b", "*** $", "one", prose(4, 60, 5), "p q r s", None]
    for docs in (documents(spark, texts), odd):
        rows = q.grade(docs, carry=["doc_id", "text"]).collect()
        assert len(rows) == docs.count()
        for row in rows:
            assert tuple(row[c] for c in q.MEASURES) == expected(row["text"])
            n, repeated = row["n_words"], row["n_repeat_words"]
            assert row["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
            assert not (row["base_failed"] and row["kept"])


def test_em_equals_the_same_in_python(spark):
    rules = q.RULES[:4]
    draws = [((1, 1, 1, 1), 700), ((-1, -1, 1, 1), 90), ((1, 1, -1, 1), 8), ((0, 1, 1, -1), 30), ((-1, -1, -1, 0), 40)]
    columns = ", ".join(f"vote_{r.name} tinyint" for r in rules)
    patterns = spark.createDataFrame([(*votes, n) for votes, n in draws], f"{columns}, n bigint")
    model = q.fit_label_model(patterns, rules, iterations=7, tolerance=0)

    import math

    prior, good, bad = 0.8, [0.98] * 4, [0.5] * 4
    for _ in range(7):
        weight = []
        for votes, _n in draws:
            odds = math.log(prior / (1 - prior))
            for v, g, b in zip(votes, good, bad):
                odds += {1: math.log(g / (1 - b)), -1: math.log((1 - g) / b), 0: 0}[v]
            weight.append(1 / (1 + math.exp(-odds)))
        total = sum(n for _, n in draws)
        prior = min(max(sum(n * w for (_, n), w in zip(draws, weight)) / total, 0.05), 0.95)
        for i in range(4):
            def mass(vote, of):
                return sum(n * of(w) for (votes, n), w in zip(draws, weight) if votes[i] == vote)
            up, down = mass(1, lambda w: w), mass(-1, lambda w: w)
            good[i] = min(max((up + 9.8) / (up + down + 10), 0.5), 0.98)
            up, down = mass(1, lambda w: 1 - w), mass(-1, lambda w: 1 - w)
            bad[i] = min(max((down + 0.5) / (up + down + 1), 1.01 - good[i]), 0.99)
    assert abs(model.prior - prior) < 1e-6
    assert all(abs(a - b) < 1e-6 for a, b in zip(model.on_good + model.on_bad, good + bad))


def test_clean_documents_stay_and_junk_goes(spark):
    clean = [prose(i, 120) + "." for i in range(60)]
    junk = [" ".join(w + "***" for w in prose(100 + i, 80).split()) for i in range(6)]
    kept = {r["doc_id"] for r in q.keep_good(documents(spark, clean + junk)).collect()}
    assert kept == set(range(60))


def test_empty_table_and_columns(spark, odd):
    assert q.keep_good(odd.limit(0)).collect() == []
    assert q.keep_good(odd).columns == odd.columns
