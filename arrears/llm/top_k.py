"""Exact top-k search by histogram selection.

Scores are never sorted or stored. Each round counts, per query, how many fall
into each bin of a score range, and the bin that holds the k-th best becomes
the next range, until it is one score wide. A last pass emits the scores above
it and the ties with the smallest ids.

Queries and rows are dealt out to blocks of a bounded size, and a task scores a
block of queries against a block of rows: a grid, of which every cell is an
equal share of one job. The ranges of all queries are a table, so a round is
as many jobs for a billion queries as for one, and nothing comes to the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.sources.scratch import stage

BINS, ROWS = 1024, 512
# Queries and rows in a block.
BLOCK, PART = 2048, 16_384

_STATE = "row bigint, low bigint, width bigint, span bigint, above bigint"


def scaled(vectors: DataFrame, vec_id: str, embedding: str, scale: int = 256) -> DataFrame:
    """``row``, ``vec_id`` and ``v``, the components as floor(scale * x).

    Rows without an id and vectors that are null or hold null or non-finite
    components take no part. ``row`` tells rows apart that repeat an id; store
    the frame before it is read twice.
    """
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias(embedding))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(embedding, lambda x: F.floor(x * F.lit(float(scale))))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", whole.alias("v"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block: int = BLOCK,
    part: int = PART,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best inner products
    of every row that ``is_query`` (an expression on ``vec_id``), ties to smaller ids.

    A query meets every row but its own, and gets all if they are fewer. Rows
    that repeat an id are rows of their own, as queries and as candidates. A
    shorter vector counts as padded with zeros. Scores are exact as long as
    they fit a long. Other columns are not read; no rows give no rows.
    """
    rows = stage(scaled(vectors, vec_id, embedding), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    size = rows.agg(
        F.max(F.sqrt(square)).alias("norm"), F.max(F.size("v")).alias("dim"), F.count_if(is_query).alias("n"), F.count("*").alias("rows")
    ).first()
    dim, norm = size["dim"] or 0, size["norm"] or 0.0
    queries, parts = max(1, math.ceil((size["n"] or 0) / block)), max(1, math.ceil(size["rows"] / part))
    # Columns of their own, so that rows and queries can meet.
    asked = rows.filter(is_query).select(*[F.col(c).alias(c) for c in rows.columns])

    def numbered(blocks: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    # Every block of rows once for each block of queries, and the other way round.
    candidates = rows.select("row", "vec_id", "v", numbered(parts).alias("part"), every(queries).alias("block"))
    candidates = candidates.groupBy("block", "part")

    def grid(state: DataFrame) -> DataFrame:
        named = state.withColumnRenamed("row", "_row")
        mine = asked.join(named, F.col("row") == F.col("_row")).drop("_row")
        return mine.select("*", numbered(queries).alias("block")).select("*", every(parts).alias("part"))

    reach = F.ceil(F.sqrt(square) * F.lit(norm)) + 1
    state = asked.select(
        "row",
        (-reach).alias("low"),
        (F.floor(2 * reach / BINS) + 1).alias("width"),
        (2 * reach + 1).alias("span"),
        F.lit(0).cast("bigint").alias("above"),
    )
    state = stage(state.selectExpr(*[f"CAST({c.split()[0]} AS bigint) AS {c.split()[0]}" for c in _STATE.split(", ")]), "ranges")
    while not (unsettled := state.filter("width > 0")).isEmpty():
        asking = grid(unsettled).groupBy("block", "part")
        counts = candidates.cogroup(asking).applyInArrow(_counter(k, dim), "row bigint, bin int, n bigint")
        state = stage(_narrowed(state, counts.groupBy("row", "bin").agg(F.sum("n").alias("n")), k), "ranges")
    found = candidates.cogroup(grid(state).groupBy("block", "part")).applyInArrow(
        _picker(k, dim), "row bigint, query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _narrowed(state: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The next ranges: for each query the best bin at which the k-th score is reached.

    A query that no bin settles has fewer than k candidates and wants all of them.
    """
    best_first = Window.partitionBy("row").orderBy(F.desc("bin"))
    reached = counts.withColumn("upto", F.sum("n").over(best_first)).withColumnRenamed("row", "_row")
    joined = state.join(reached, F.col("row") == F.col("_row"), "left")
    at = F.when(F.col("upto") >= F.lit(k) - F.col("above"), F.struct("bin", (F.col("upto") - F.col("n")).alias("before")))
    best = joined.groupBy("row", "low", "width", "span", "above").agg(F.max(at).alias("at"))
    wide = F.col("width")
    return best.select(
        "row",
        F.when(wide == 0, F.col("low"))
        .when(F.col("at").isNull(), F.lit(-(1 << 63)))
        .otherwise(F.col("low") + wide * F.col("at.bin"))
        .alias("low"),
        F.when((wide <= 1) | F.col("at").isNull(), 0).otherwise(F.floor((wide - 1) / BINS) + 1).cast("bigint").alias("width"),
        F.when(wide == 0, F.col("span")).otherwise(wide).alias("span"),
        F.when(wide == 0, F.col("above")).when(F.col("at").isNull(), 0).otherwise(F.col("above") + F.col("at.before")).cast("bigint").alias("above"),
    )


def _counter(k: int, dim: int):
    """Counts per query and bin of a cell; only the best bins that already hold k scores,
    since no lower one can hold the k-th best of all."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        low, width, span = (queries.column(c).to_numpy()[:, None] for c in ("low", "width", "span"))
        own, asked = queries.column("row").to_numpy(), _matrix(queries, dim)
        counts = np.zeros((len(own), BINS), np.int64)
        base = (np.arange(len(own)) * BINS)[:, None]
        for at in range(0, rows.num_rows, ROWS):
            some = rows.slice(at, ROWS)
            scores = _scores(asked, _matrix(some, dim))
            inside = (scores >= low) & (scores < low + span) & (own[:, None] != some.column("row").to_numpy()[None, :])
            bins = (scores - low) // width
            counts += np.bincount((bins + base)[inside], minlength=counts.size).reshape(counts.shape)
        better = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (better < k))
        return pa.table([pa.array(own[q]), pa.array(b.astype(np.int32)), pa.array(counts[q, b])], names=["row", "bin", "n"])

    return run


def _picker(k: int, dim: int):
    """Scores better than the k-th, and of those equal to it a cell's smallest ids."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        low, above = (queries.column(c).to_numpy() for c in ("low", "above"))
        own, names, asked = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy(), _matrix(queries, dim)
        parts = []
        ties: list[list[int]] = [[] for _ in own]
        for at in range(0, rows.num_rows, ROWS):
            some = rows.slice(at, ROWS)
            ids = some.column("vec_id").to_numpy()
            scores = _scores(asked, _matrix(some, dim))
            other = own[:, None] != some.column("row").to_numpy()[None, :]
            q, c = np.nonzero((scores > low[:, None]) & other)
            parts.append(_found(own[q], names[q], ids[c], scores[q, c]))
            q, c = np.nonzero((scores == low[:, None]) & other)
            for i in np.unique(q).tolist():
                ties[i] = sorted(ties[i] + ids[c[q == i]].tolist())[: k - int(above[i])]
        q = np.repeat(np.arange(len(ties)), [len(t) for t in ties])
        parts.append(_found(own[q], names[q], np.array([i for t in ties for i in t], np.int64), low[q]))
        return pa.concat_tables(parts)

    return run


def _found(row: np.ndarray, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.Table:
    columns = [pa.array(x.astype(np.int64)) for x in (row, query, vec, score)]
    return pa.table(columns, names=["row", "query_id", "vec_id", "score"])


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    """The column ``v`` as a matrix, shorter vectors padded with zeros."""
    lists = table.column("v").combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy()
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    matrix = np.zeros((len(sizes), dim), np.int64)
    matrix[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return matrix


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point, which is faster, where that is exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


ORACLE = """
WITH finite AS (
  SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.own, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM finite q JOIN finite c ON q.vec_id % 50 = 0 AND q.own <> c.own),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
