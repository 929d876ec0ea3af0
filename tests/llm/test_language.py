import random
import zlib

import numpy as np
from arrears.llm import language as g

from .conftest import SCHEMA


def slow_phrases(text, reference):
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in reference:
            n += 1
        count, at = count + 1, at + n
    return count


def test_phrases_equal_greedy_parsing():
    draw = random.Random(2)
    for _ in range(30):
        a, b = ("".join(draw.choice("abc") for _ in range(n)) for n in (120, draw.randint(1, 400)))
        model = g.train({"x": [a]})
        assert g.phrases(model, [g.encode(b, model.classes)])[0, 0] == slow_phrases(b, a)
    assert slow_phrases("zz", "abc") == 2
    assert g.phrases(model, [g.encode("zz", model.classes)])[0, 0] == 2


def test_rare_letters_are_told_apart():
    draw = random.Random(4)
    letters = [chr(0x4E00 + i) for i in range(600)]
    for n_letters in (0, 3, 250):
        a, b = ("".join(draw.choice(letters[:k]) for _ in range(n)) for n, k in ((900, 500), (1500, 600)))
        b += a[100:160] + a[7:300]
        model = g.train({"x": [a], "y": [b]}, letters=n_letters)
        counts = g.phrases(model, [g.encode(b, model.classes), g.encode("abc" + a, model.classes)])
        assert counts.tolist()[0] == [sum(slow_phrases(b[i : i + 512], r) for i in range(0, len(b), 512)) for r in (a, b)]
        assert counts[1, 0] == sum(slow_phrases(("???" + a)[i : i + 512], a) for i in range(0, len(a) + 3, 512))


def test_every_drawn_text_has_an_equal_share():
    assert g.equal_parts(["a" * 50_000, "b" * 10, "c" * 9000], 16_000) == ["a" * 7995, "b" * 10, "c" * 7995]
    assert g.equal_parts([], 5) == [] and g.equal_parts(["ab", "cd"], 9) == ["ab", "cd"]
    model = g.train({"x": ["abab" * 10_000, "zyxw" * 10]})
    assert g.phrases(model, [g.encode("zyxw", model.classes)])[0, 0] == 1


def test_long_texts_are_parsed_whole():
    model = g.train({"x": ["abcd" * 50], "y": ["wxyz" * 50]})
    names, scores = g.classify(model, ["abcd" * 300 + "wxyz" * 5000, "ABCD abcd", "", None, "123 !?", "漢字"])
    assert names == ["y", "x", "und", "und", "und", "x"] and ((0 <= scores) & (scores <= 1)).all()


def test_held_out_accuracy_on_the_test_tables(spark):
    import os

    import pytest

    if not os.path.exists("/root/testdata/sf0.01"):
        pytest.skip("no test tables")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = g.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.98


def test_odd_rows(spark, odd):
    rows = g.identify(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        i = r["doc_id"]
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
        assert (r["lang_pred"] == "und") == (i in (2, 3, 4)) or i is None
    assert g.identify(odd.limit(0)).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text", None, None, 9)], SCHEMA)
    assert [tuple(r)[2:] for r in g.identify(unlabelled).collect()] == [("und", 0.0)]
    assert np.isfinite([r["score"] for r in rows]).all()


def test_whole_texts_within_the_budget():
    assert g.whole_texts(["abc", "defgh", "ij", "k"], 6) == ["abc", "ij", "k"]
    assert g.whole_texts(["abcdef"], 4) == ["abcd"] and g.whole_texts([], 4) == []


def test_a_language_under_one_id_is_learnt_from_few_rows(spark):
    """Neither repeated ids nor repeated rows decide how many rows are drawn."""
    draw = random.Random(3)
    rows = [(7, "".join(draw.choice("abcd ") for _ in range(60)), "x", None, None) for _ in range(300)]
    rows += [(9, "wxyz " * 9, "y", None, None)] * 400 + [(i, "m" * 900, "z", None, None) for i in range(20)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = g.drawn_rows(frame, 10, 500).collect()
    sizes = {lang: sum(r["lang"] == lang for r in found) for lang in "xyz"}
    assert sizes == {"x": 10, "y": 1, "z": 10}
    assert {r["text"] for r in found if r["lang"] == "x"} <= {r[1] for r in rows}
    again = g.drawn_rows(frame.orderBy("text").coalesce(2), 10, 500).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_many_languages_share_the_tables(spark):
    draw = random.Random(6)
    rows = []
    for n in range(200):
        letters = "".join(draw.sample("abcdefghijklmnopqrstuvwxyz", 6)) + " "
        rows += [(1000 * n + i, "".join(draw.choice(letters) for _ in range(300)), f"l{n:03}", None, None) for i in range(4)]
    model = g.learn(spark.createDataFrame(rows, SCHEMA), table_bytes=32 << 20)
    assert len(model.languages) == 200 and sum(t.nbytes for t in model.tables) < 32 << 20
    texts = ["".join(draw.choice(rows[4 * n][1]) for _ in range(600)) for n in range(0, 200, 20)]
    names, _ = g.classify(model, texts)
    assert sum(name == f"l{n:03}" for name, n in zip(names, range(0, 200, 20))) >= 8
