import random

import numpy as np
import pytest
import xxhash
from arrears.llm import simhash as s
from arrears.llm.components import connected
from pyspark.sql import functions as F

from .conftest import documents, prose


def slow_fingerprint(text):
    words = text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in pairs:
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("text", ["", "A", "a B c", "a b c d", "É é X y z", prose(5, 300)])
def test_fingerprint(text):
    assert s.fingerprint(text.encode()) == slow_fingerprint(text)


def assert_linked(spark, values, bits, **sizes):
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    stars = {r["node"]: r["root"] for r in connected(s.near_links(frame, bits, **sizes)).collect()}
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= bits]
    found, expected = {}, {}
    for i, (v, r) in enumerate(zip(signed, roots(len(values), pairs))):
        found.setdefault(stars.get(v, v), set()).add(i)
        expected.setdefault(r, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("subtree", [8192, 20])
@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 7])
def test_links_connect_what_all_pairs_connect(spark, subtree, bits):
    draw = random.Random(bits)
    base = [draw.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << i for i in draw.sample(range(64), draw.randint(0, 9))) for b in base for _ in range(6)]
    assert_linked(spark, sorted({0, (1 << 64) - 1, *base, *near}), bits, subtree=subtree)


@pytest.mark.parametrize("bits", [4])
@pytest.mark.parametrize("mask", [(1 << 64) - 1, 0xFFFF_FFFF << 32])
def test_crowded_subtrees_are_split(spark, bits, mask):
    """Fingerprints that differ from one center in few places, or in the same half only."""
    draw = random.Random(bits)
    places = [i for i in range(64) if mask >> i & 1]
    ball = {0xF123456789ABCDEF ^ sum(1 << i for i in draw.sample(places, draw.randint(0, 7))) for _ in range(400)}
    assert_linked(spark, sorted(ball), bits, subtree=100, largest=100)


def test_crowded_nodes_without_a_partner_reach_no_task(spark):
    """A crowd under one prefix, whose partners under every mask but one are empty."""
    draw = random.Random(3)
    values = sorted({0x5 << 60 | draw.getrandbits(60) for _ in range(300)} | {0x4 << 60 | draw.getrandbits(60) for _ in range(5)})
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    own = F.shiftrightunsigned("fp", 60)
    rows = fps.select(F.lit(0).alias("swapped"), "fp", own.alias("own"), s._masks(4, 2).alias("mask"))
    dealt = s._split(s._node_pairs(rows, 4), 4, {0: 2, 1: 1}, 4, 100)
    sizes = dealt.groupBy(*s.NODE_PAIR).count().collect()
    assert sizes and max(r["count"] for r in sizes) <= 100
    assert_linked(spark, values, 4, subtree=20, largest=100)


def test_walk_finds_every_pair_of_a_dense_ball():
    center = 0x0123456789ABCDEF
    ball = np.array(sorted({center ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}), np.uint64)
    n = sum(len(i) for i, _ in s.walk(ball, None, 0, 64, 4))
    assert n == len(ball) * (len(ball) - 1) // 2


def test_classes_of_odd_rows(spark, odd):
    rows = s.near_classes(odd).collect()
    assert len(rows) == odd.count()
    texts = {}
    for r in odd.collect():
        texts.setdefault((r["doc_id"], slow_fingerprint(r["text"] or "")), 0)
    for r in rows:
        assert (r["doc_id"], r["fp"] % (1 << 64)) in texts
    # The copy without an id is in the class of document 1, texts without words share one.
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {1, 2}
    assert s.near_classes(odd.limit(0)).collect() == []


def test_one_of_each_class_stays(spark, odd):
    kept = s.keep_first(odd)
    assert kept.columns == odd.columns
    classes = {r["component_id"] for r in s.near_classes(odd).collect()}
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted(classes)
    copies = documents(spark, ["same text of a few words here", *["other words stand in this one"] * 50])
    assert sorted(r["doc_id"] for r in s.keep_first(copies).collect()) == [0, 1]
