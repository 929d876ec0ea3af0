import math
import random

import pytest
from arrears.llm import top_k as t
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>"


def slow(rows, k=5):
    """Every row is a query or a candidate of its own, also if it repeats an id."""
    kept = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for n, (q, own) in enumerate(kept):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for m, (i, v) in enumerate(kept) if m != n)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(frame, **options):
    return sorted(map(tuple, t.top_k(frame, F.col("vec_id") % 50 == 0, **options).collect()))


@pytest.mark.parametrize(("block", "part"), [(2048, 16_384), (3, 150)])
def test_equals_brute_force(spark, block, part):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.25, 0.3, 1.0]) for _ in range(4)]) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(200)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4), block=block, part=part) == slow(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [0.5, 1.0]), (50, [1.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0])]
    rows += [(4, [float("inf"), 1.0]), (None, [9.0, 9.0]), (5, [-1.0, 0.5]), (100, [])]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS rank")
    assert found(frame) == slow(rows)
    assert found(frame.filter("vec_id = 0").limit(1)) == [] and found(frame.limit(0)) == []


def test_rows_that_repeat_an_id_are_all_kept(spark):
    rows = [(50, [1.0, 2.0]), (7, [2.0, 0.0]), (7, [0.5, 9.0]), (7, [0.5, 9.0]), (50, [3.0, 1.0]), (8, [1.0, 1.0])]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == slow(rows) and sum(r[2] == 7 for r in got) == 6 and sum(r[0] == 50 for r in got) == 10


def test_a_round_takes_as_many_jobs_for_many_blocks(spark):
    """The tracker counts jobs of a group: they must not grow with the blocks of queries."""
    rows = [(i * 50, [float(i % 7), float(i % 5) - 2.0]) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    context, jobs = spark.sparkContext, []
    for block in (64, 2):
        context.setJobGroup(f"top-{block}", "blocks")
        found(frame, block=block)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"top-{block}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert abs(jobs[0] - jobs[1]) <= 4


def test_large_components(spark):
    rows = [(i, [float(i) * 2**14, 1.0, -3.0 * 2**20]) for i in range(0, 120, 10)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == slow(rows)
