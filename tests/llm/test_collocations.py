import random
import re
from collections import Counter

import numpy as np
import pytest
from arrears.llm import collocations as c
from pyspark.sql import functions as F

from .conftest import documents, prose


def slow(rows, least=10, first=2000):
    """The report of (text, language) rows by plain counters."""
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    longest = Counter()
    for (lang, words), n in candidates.items():
        if len(words) == 3:
            for part in (words[:2], words[1:]):
                longest[lang, part] = max(longest[lang, part], n)
    out = []
    for lang in sizes:
        mine = []
        for (of, words), a in candidates.items():
            if of == lang and 100 * longest[lang, words] < 50 * a:
                cuts = []
                for k in range(1, len(words)):
                    left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                    cuts.append((10**6 * a * a // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                mine.append((-score, -a, " ".join(words).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, c.collocations(docs, **options).collect()))


def plain(docs):
    return [(r["text"], r["lang"]) for r in docs.collect()]


def sample(spark, seed):
    draw = random.Random(seed)
    words = ["New", "york", "of", "the", "THE", "é", "Éa", "x\x85y", "a\xa0b", "\xff", "漢字", "ab#"]
    gaps = [" "] * 12 + ["\t", ". ", ",", "\n", "  ", "!\x0b", " ;"]
    texts = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 90))) for _ in range(120)]
    docs = documents(spark, texts[:60]).unionByName(documents(spark, texts[60:90], lang="de"))
    return docs.unionByName(documents(spark, texts[90:], lang=None))


@pytest.mark.parametrize("seed", range(2))
def test_report_equals_plain_counters(spark, seed):
    docs = sample(spark, seed)
    assert found(docs.repartition(4)) == slow(plain(docs))


def test_first_of_many_and_overlap(spark):
    docs = documents(spark, [prose(3, 900, words=25), "a b c. " * 30 + "a b " * 20, "p q r " * 12])
    assert found(docs, first=7) == slow(plain(docs), first=7)
    phrases = {r[2] for r in found(docs)}
    assert "a b c" in phrases and "a b" not in phrases and "q r" not in phrases


def test_split_stripes_and_small_chunks_change_nothing(spark, monkeypatch):
    """A very common pair, stripes split at every level, texts cut between any two words."""
    texts = [f"of the {prose(i, 6, words=30)} of the of the" for i in range(80)]
    docs = documents(spark, texts)
    want = slow(plain(docs))
    assert found(docs) == want
    hot = c.hot_classes(docs.select("lang", "text"), 64)
    assert hot[0].any() and hot[1].any()
    monkeypatch.setattr(c, "hot_classes", lambda rows, buckets: (np.ones(1 << 16, bool), np.ones(1 << 20, bool)))
    assert found(docs) == want
    monkeypatch.undo()
    batch = docs.select("lang", "text").toArrow().to_batches()
    whole = {key: n for chunk in c.chunks(iter(batch)) for key, n in tally(chunk)}
    for size in (4, 5, 8, 31):
        monkeypatch.setattr(c, "CHUNK", size)
        parts = Counter()
        for chunk in c.chunks(iter(batch)):
            assert sum(len(x[2]) for x in chunk) <= max(size, size // 2 + 3)
            for key, n in tally(chunk):
                parts[key] += n
        assert parts == whole


def tally(chunk):
    for lang, vocabulary, numbers in chunk:
        words = list(vocabulary)
        codes, n = c.counts(numbers)
        for row in zip(*(p.tolist() for p in c._parts(codes)), n.tolist()):
            yield (lang, *(words[w] for w in row[:3])), row[3]


def test_stripes_survive_packing():
    words = [c.END, b"a", b"bb", "é".encode(), b"z"]
    codes = np.array([1 << 42, 1 << 42 | 3 << 21, 3 << 42 | 3 << 21 | 1, 4 << 42], np.int64)
    named, rows = c._unpack(c._pack(words, codes, np.array([5, 4, 3, 70_000])))
    assert named == [b"a", "é".encode(), b"z"]
    assert rows.tolist() == [[1, 1, 2, 3], [0, 2, 2, 0], [0, 0, 1, 0], [5, 4, 3, 70_000]]


def test_merging_with_large_vocabularies():
    draw = np.random.default_rng(1)
    rows = draw.integers(0, 3, (4, 200)).astype(np.uint32)
    small = c.merged_stripes(rows)
    scale = np.uint32(1 << 22)
    big = c.merged_stripes(rows * np.array([[scale], [scale], [scale], [1]], np.uint32))
    assert all((a * s == b).all() for a, b, s in zip(small, big, (1 << 22, 1 << 22, 1 << 22, 1)))
    assert small[3].sum() == rows[3].sum()


def test_scores_are_exact_beyond_64_bits(spark):
    counts = [(10**14 + 7, 10**14 + 9, 10**14 + 31), (10, 10, 10), (123_456_789, 987_654_321_987, 123_456_790), (1, 10**14, 10**14)]
    frame = spark.createDataFrame(counts, "a bigint, l bigint, r bigint")
    got = [r[0] for r in frame.select(c.exact_score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * a * a // (left * right) for a, left, right in counts]


def test_odd_rows(spark, odd):
    named = odd.selectExpr("*", "1 AS w1", "2 AS phrase", "3 AS n", "4 AS rank")
    assert found(named, least=2) == slow(plain(odd), least=2)
    assert found(odd.limit(0)) == []
    assert found(odd.filter("text IS NULL OR doc_id = 4"), least=1) == []
