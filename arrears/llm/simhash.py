"""SimHash near-duplicates by a joint traversal of two binary tries.

A sorted array of fingerprints is a binary trie: a node is a range with a
common prefix. Pairs of nodes are followed down together, the bits in which
they differ add up, and a pair goes as soon as they exceed its budget.

Two fingerprints that differ in at most ``max_bits`` = b bits differ in at
most b // 2 bits of their upper half, or in at most (b - 1) // 2 of their
lower. So two traversals, the second with the halves swapped, start under a
tighter budget for 32 levels and together miss no pair. Spark deals out pairs
of subtrees; each task walks its pairs in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.components import connected
from arrears.llm.frames import text_key
from arrears.sources.scratch import stage

BITS, HALF, SEED = 64, 32, 42
LEAF_PAIRS, FRONTIER = 64, 1 << 18
LAST_DEPTH = 60
# What names a pair of subtrees: their common depth and the prefixes of both.
NODE_PAIR = ("swapped", "depth", "left", "right")


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Bit i is set if it is set in more than half of the shingles' XXH64 hashes.

    ASCII letters count as lower case and words end at ASCII white space.
    Fewer words than a shingle make one shingle; no words give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    places = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in places], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``doc_id``, ``text_key`` and ``fp`` (the 64 bits as a long) per row; a null text is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            values = [fingerprint(x.as_py() or b"", shingle) for x in texts]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], schema=schema)

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


def walk(a: np.ndarray, b: np.ndarray | None, depth: int, half_bits: int, max_bits: int) -> Iterator[tuple]:
    """Pairs of places (i, j) in two sorted arrays of distinct values that lie
    within ``half_bits`` in their upper half and ``max_bits`` in all.

    Each array is a subtree: its values share their first ``depth`` bits. With
    ``b`` None the pairs lie within ``a``, each once. Frontiers wait on a
    stack in portions, so memory does not grow with the number of pairs.
    """
    own, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return
    differing = int(a[0] ^ b[0]) >> (BITS - depth) if depth else 0
    first = np.array([[0, len(a), 0, len(b), differing.bit_count()]], np.int64)
    stack = [(depth, first)]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > FRONTIER:
            stack.extend((depth, part) for part in np.array_split(nodes, math.ceil(len(nodes) / FRONTIER)))
            continue
        small = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= LEAF_PAIRS
        if depth == BITS:
            small[:] = True
        if small.any():
            yield _leaf_pairs(a, b, nodes[small], half_bits, max_bits, own)
        nodes = nodes[~small]
        if len(nodes):
            stack.append((depth + 1, _children(a, b, nodes, depth, half_bits if depth < HALF else max_bits, own)))


def _children(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, depth: int, budget: int, own: bool) -> np.ndarray:
    """Each pair of nodes by their next bit: two pairs that agree, two that differ."""
    low = np.uint64((1 << (BITS - depth)) - 1)
    bit = np.uint64(1 << (BITS - 1 - depth))
    a0, a1, b0, b1, errors = nodes.T
    am = np.searchsorted(a, (a[a0] & ~low) | bit)
    bm = np.searchsorted(b, (b[b0] & ~low) | bit)
    same = own & (a0 == b0) & (a1 == b1)
    crossing = np.where(same, a0, a1)  # of a node with itself one of the two crossings is enough
    found = np.concatenate(
        [
            np.stack([a0, am, b0, bm, errors], 1),
            np.stack([am, a1, bm, b1, errors], 1),
            np.stack([a0, am, bm, b1, errors + 1], 1),
            np.stack([am, crossing, b0, bm, errors + 1], 1),
        ]
    )
    return found[(found[:, 0] < found[:, 1]) & (found[:, 2] < found[:, 3]) & (found[:, 4] <= budget)]


def _leaf_pairs(
    a: np.ndarray, b: np.ndarray, nodes: np.ndarray, half_bits: int, max_bits: int, own: bool
) -> tuple[np.ndarray, np.ndarray]:
    a0, a1, b0, b1, _ = nodes.T
    width = b1 - b0
    n = (a1 - a0) * width
    node = np.repeat(np.arange(len(nodes)), n)
    k = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n)
    i, j = a0[node] + k // width[node], b0[node] + k % width[node]
    if own:
        i, j = i[i < j], j[i < j]
    differing = a[i] ^ b[j]
    near = np.bitwise_count(differing) <= max_bits
    near &= np.bitwise_count(differing >> np.uint64(HALF)) <= half_bits
    return i[near], j[near]


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest place reachable from each of ``n`` places."""
    root = np.arange(n)
    for i, j in links:
        i, j = root[i], root[j]
        while len(i):
            differ = i != j
            i, j = i[differ], j[differ]
            np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
            while True:
                jumped = root[root]
                if (jumped == root).all():
                    break
                root = jumped
            i, j = root[i], root[j]
    return root


def near_links(fps: DataFrame, max_bits: int = 4, subtree: int = 8192, largest: int = 1 << 20) -> DataFrame:
    """Links ``a``, ``b`` between the distinct values ``fp`` whose components are
    those of all pairs within ``max_bits`` bits.

    A pair of subtrees yields a star per component it finds and not every
    pair, so a large group of near copies costs its size. The depth of the
    subtrees grows with the number of fingerprints: about ``subtree`` each.
    Where fingerprints crowd under one prefix, pairs of subtrees with more than
    ``largest`` are followed down in Spark, four levels at a time, first.
    """
    count = fps.count()
    depth = max(0, min(HALF, math.ceil(math.log2(max(1, count / subtree)))))
    half_bits = {0: max_bits // 2} | ({1: (max_bits - 1) // 2} if max_bits else {})

    dealt = None
    crowded = False
    for swapped, bits in half_bits.items():
        rows = fps.select(_turned("fp").alias("fp") if swapped else F.col("fp"))
        own = F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("bigint")
        if count > largest:
            fullest = rows.groupBy(own.alias("own")).count().agg(F.max("count")).first()[0]
            crowded |= 2 * fullest > largest
        pairs = rows.select(F.lit(swapped).alias("swapped"), "fp", own.alias("own"), _masks(depth, bits).alias("mask"))
        pairs = _node_pairs(pairs, depth)
        dealt = pairs if dealt is None else dealt.unionByName(pairs)
    if crowded:
        dealt = _split(dealt, depth, half_bits, max_bits, largest)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        swapped, depth, left, right = (table.column(c)[0].as_py() for c in NODE_PAIR)
        values = np.sort(table.column("fp").to_numpy().view(np.uint64))
        if left == right:
            a, b = values, None
        else:
            cut = np.searchsorted(values, np.uint64(right << (BITS - depth)))
            a, b = values[:cut], values[cut:]
        offset = 0 if b is None else len(a)
        links = ((i, j + offset) for i, j in walk(a, b, depth, half_bits[swapped], max_bits))
        root = forest(len(values), links)
        child = np.flatnonzero(root != np.arange(len(values)))
        u, v = values[child], values[root[child]]
        if swapped:
            u, v = ((x << np.uint64(32)) | (x >> np.uint64(32)) for x in (u, v))
        return pa.table([u.view(np.int64), v.view(np.int64)], schema=schema)

    return dealt.groupBy(*NODE_PAIR).applyInArrow(run, "a bigint, b bigint")


def _turned(column: str) -> Column:
    return F.expr(f"(shiftleft({column}, 32) | shiftrightunsigned({column}, 32))")


def _masks(levels: int, bits: int) -> Column:
    """A row per way to differ in at most ``bits`` of ``levels`` bits."""
    chosen = [c for n in range(min(bits, levels) + 1) for c in combinations(range(levels), n)]
    return F.explode(F.array(*[F.lit(sum(1 << i for i in c)).cast("bigint") for c in chosen]))


def _node_pairs(rows: DataFrame, depth: int) -> DataFrame:
    """The pair of nodes that a fingerprint under ``own`` joins for a ``mask``."""
    other = F.col("own").bitwiseXOR(F.col("mask"))
    return rows.select(
        "swapped",
        F.lit(depth).alias("depth"),
        F.least("own", other).alias("left"),
        F.greatest("own", other).alias("right"),
        "fp",
    )


def _split(dealt: DataFrame, depth: int, half_bits: dict[int, int], max_bits: int, largest: int) -> DataFrame:
    """``dealt`` with every pair of nodes that has more than ``largest`` fingerprints
    replaced by those pairs of its descendants that are within the budget.

    Of two nodes one of which is empty there are no links: such a pair goes.
    A pair at depth 60 has at most 32 fingerprints, so the descent ends.
    """
    settled = []
    while depth < LAST_DEPTH:
        dealt = stage(dealt, "dealt")
        side = F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("bigint")
        sizes = dealt.groupBy(*NODE_PAIR).agg(F.count("*").alias("n"), F.min(side).alias("a"), F.max(side).alias("b"))
        both = (F.col("left") == F.col("right")) | (F.col("a") < F.col("b"))
        large = stage(sizes.filter(F.col("n") > largest).select(*NODE_PAIR, both.alias("both")), "crowded")
        if large.isEmpty():
            break
        settled.append(dealt.join(large, list(NODE_PAIR), "left_anti"))
        crowded = large.filter("both")
        deeper = min(HALF if depth < HALF else LAST_DEPTH, depth + 4)
        step = deeper - depth
        differing = F.col("left").bitwiseXOR(F.col("right"))
        spare = F.lit(max_bits)
        if deeper <= HALF:
            for swapped, bits in half_bits.items():
                spare = F.when(F.col("swapped") == swapped, bits).otherwise(spare)
        children = (
            dealt.join(crowded, list(NODE_PAIR), "left_semi")
            .select("swapped", "fp", differing.alias("differing"), spare.alias("spare"), _masks(step, step).alias("low"))
            .filter(F.bit_count("differing") + F.bit_count("low") <= F.col("spare"))
            .select(
                "swapped",
                "fp",
                F.shiftrightunsigned("fp", BITS - deeper).alias("own"),
                F.shiftleft("differing", step).bitwiseOR(F.col("low")).alias("mask"),
            )
        )
        dealt, depth = _node_pairs(children, deeper), deeper
    for part in settled:
        dealt = dealt.unionByName(part)
    return dealt


def near_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """``doc_id``, ``text_key``, ``fp`` and ``component_id`` of every row.

    ``component_id`` is the smallest id reachable over links of ``max_bits``
    or fewer differing bits (null if no reachable row has an id). Texts without
    words have fingerprint 0 and are linked like any other; equal texts have
    equal fingerprints and one component, so copies are never paired up. No
    rows give no rows, and other columns are not read.
    """
    rows = stage(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    stars = connected(near_links(distinct.select("fp"), max_bits))
    rooted = distinct.join(stars, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(lowest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(classes, F.col("fp") == F.col("_fp")).drop("_fp")


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the one with its smallest id.

    Of a component without ids, and of rows that repeat an id, the one with
    the smallest text key stays; rows that repeat both count as one document.
    """
    classes = near_classes(docs, shingle=shingle, max_bits=max_bits)
    # With a null id the whole component has none, so its fingerprint names it.
    name = F.coalesce("component_id", "fp")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("text_key").isNotNull(), "text_key")
    kept = stage(
        classes.groupBy("component_id", F.when(F.col("component_id").isNull(), name).alias("name"))
        .agg(F.min(order).alias("row"), F.count("*").alias("n"))
        .select(F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key"), "n"),
        "kept",
    )
    mine = docs.withColumn("_text_key", text_key()).alias("d")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & F.col("_text_key").eqNullSafe(F.col("_key"))
    left = mine.join(kept.select("_id", "_key"), same, "left_semi")
    repeated = (
        classes.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter("n > 1").select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
        )
    )
    if repeated.isEmpty():
        return left.drop("_text_key")
    twice = stage(repeated, "repeated")
    once = left.join(twice, same, "left_anti")
    return once.unionByName(left.join(twice, same, "left_semi").dropDuplicates(["doc_id", "_text_key"])).drop(
        "_text_key"
    )
