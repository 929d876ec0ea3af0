"""Mixing by iterative proportional fitting, with DataFrame functions only.

Tokens are summed per cell of source, language and topic. Raking scales the
cells to one target marginal after another until all agree. Probabilities
cannot exceed 1, so the tokens that a rate keeps are raked once more under that
bound: cells that reach it are fixed, the others are raked on, until what is
expected to be kept meets every target. Documents are then taken in order of a
hash, up to the calibrated share of their cell's tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.frames import text_key, text_or_empty, unit_hash
from arrears.sources.scratch import discard, scratch_path, stage

BROADCAST_CELLS = 20_000

# From here on a probability is 1: the last digits of a sum must not decide which cells are fixed.
AT_BOUND = 1 - 1e-12

# Expected tokens are added up as whole tokens and two parts of so many to one, which are whole numbers too.
PART = float(1 << 26)

# Hashes of a cell are counted in so many bins, and those of the bin that holds the threshold once more.
DRAW_BINS = 4096


@dataclass(frozen=True)
class Target:
    """The wished shares of tokens by the levels of a column.

    ``shares`` fixes levels; all others share the rest in proportion to their
    tokens to the power of ``temper`` (1 keeps proportions, 0 levels them).
    """

    column: str
    temper: float = 1.0
    shares: Mapping[str, float] = field(default_factory=dict)


# Flattened, so that a hot source or the largest language does not rule the mix.
TARGETS = (
    Target("source", temper=0.7),
    Target("lang", temper=0.7),
    Target("topic", temper=0.85),
)


@dataclass(frozen=True)
class Topic:
    """A topic's terms, and how many of them a thousand bytes must have."""

    name: str
    terms: tuple[str, ...]
    least: float


# What texts of a topic are full of.
TOPICS = (
    Topic("legal", ("icense", "opyright", "arrant", "iabilit", "rights"), 0.5),
    Topic("contact", ("http", "www.", "@"), 0.5),
    Topic("table", (" | ", "\t"), 8.0),
    Topic("code", ("{", "()", "</", "def ", "import ", "return ", " = "), 3.0),
    Topic("talk", ("?", "!", '"'), 8.0),
)


def topic(text: Column) -> Column:
    """The topic whose terms are the densest, in multiples of its least density; ``prose`` if none reaches it.

    Ties go to the first in ``TOPICS``. Terms are counted by what a text loses
    with them, and only where it has them: no regular expression is needed.
    """
    size = F.octet_length(text)

    def places(term: str) -> Column:
        lost = size - F.octet_length(F.replace(text, F.lit(term), F.lit("")))
        return F.when(F.contains(text, F.lit(term)), lost / F.lit(float(len(term)))).otherwise(0.0)

    found = [
        F.struct(
            F.try_divide(sum((places(term) for term in t.terms), F.lit(0.0)) * 1000.0, size * t.least).alias("density"),
            F.lit(-i).alias("first"),
            F.lit(t.name).alias("name"),
        )
        for i, t in enumerate(TOPICS)
    ]
    prose = F.struct(F.lit(1.0).alias("density"), F.lit(-len(TOPICS)).alias("first"), F.lit("prose").alias("name"))
    return F.greatest(*found, prose)["name"]


def target_levels(cells: DataFrame, target: Target) -> DataFrame:
    """``level``, ``goal`` (tokens) and ``held`` (tokens) for every level that has tokens; goals add up to the total."""
    levels = cells.groupBy(F.col(target.column).alias("level")).agg(F.sum("tokens").cast("double").alias("tokens"))
    levels = levels.filter("tokens > 0")
    fixed = F.lit(None).cast("double")
    for level, share in target.shares.items():
        fixed = F.when(F.col("level") == level, F.lit(float(share))).otherwise(fixed)
    levels = levels.withColumns({"fixed": fixed, "free": F.when(fixed.isNull(), F.pow("tokens", F.lit(target.temper)))})
    total = levels.agg(F.sum("tokens").alias("t"), F.sum("fixed").alias("fixed"), F.sum("free").alias("free")).first()
    listed, free = total["fixed"] or 0.0, total["free"] or 0.0
    rest = max(0.0, 1.0 - listed) if listed < 1.0 else 0.05 * listed
    scale = (total["t"] or 0.0) / (listed + (rest if free else 0.0) or 1.0)
    share = F.coalesce("fixed", F.col("free") * F.lit(rest / free if free else 0.0))
    return levels.select("level", (share * F.lit(scale)).alias("goal"), F.col("tokens").alias("held")).filter("goal > 0")


def rake(
    cells: DataFrame, targets: Sequence[Target] = TARGETS, iterations: int = 30, tolerance: float = 1e-4
) -> DataFrame:
    """Add ``weight``, the fitted over the observed tokens of a cell.

    ``cells`` has the targets' columns, without nulls, and ``tokens``. Cells
    without tokens get a null weight. Every step is one small grouped sum and
    one join, written out; steps that are no longer read are deleted.
    """
    spark, columns = cells.sparkSession, [t.column for t in targets]
    goals = [(t.column, stage(target_levels(cells, t).coalesce(1), "goals")) for t in targets]
    path, first = scratch_path(spark, "rake"), cells.withColumn("fit", F.col("tokens").cast("double"))
    count = cells.count()
    first.coalesce(max(1, count // 100_000)).write.parquet(f"{path}/0")
    fitted, step = spark.read.schema(first.schema).parquet(f"{path}/0"), 0
    for _ in range(iterations):
        worst = 0.0
        for i, (column, goal) in enumerate(goals):
            sums = fitted.groupBy(F.col(column).alias("level")).agg(F.sum("fit").alias("sum"))
            factors = sums.join(goal, "level", "left").select("level", F.try_divide("goal", "sum").alias("factor"))
            if i == 0:
                worst = factors.agg(F.max(F.abs(F.col("factor") - 1))).first()[0] or 0.0
            moved = fitted.join(factors, F.col(column) == F.col("level")).select(
                *cells.columns, (F.col("fit") * F.coalesce("factor", F.lit(0.0))).alias("fit")
            )
            step += 1
            moved.write.parquet(f"{path}/{step}")
            discard(spark, f"{path}/{step - 1}")
            fitted = spark.read.schema(first.schema).parquet(f"{path}/{step}")
        if worst < tolerance:
            break
    return fitted.select(*columns, "tokens", F.try_divide("fit", "tokens").alias("weight"))


def scale_for(cells: DataFrame, rate: float) -> float:
    """The factor c for which probabilities min(1, c * weight) keep ``rate`` of the tokens.

    The kept tokens grow with c, so a grid of 32 factors is summed up in one
    pass and refined three times.
    """
    row = cells.filter("weight > 0").agg(F.min("weight").alias("low"), F.sum("tokens").alias("tokens")).first()
    if not row["tokens"] or rate >= 1:
        return float("inf")
    low, high = rate, max(rate, 1.0 / row["low"])
    for _ in range(4):
        grid = [low * (high / low) ** (i / 32) for i in range(33)]
        kept = [F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * c)).alias(f"k{i}") for i, c in enumerate(grid)]
        sums = cells.agg(*kept).first()
        above = next((i for i in range(33) if sums[i] >= rate * row["tokens"]), 32)
        low, high = grid[max(0, above - 1)], grid[above]
    return high


def kept_goals(goals: DataFrame, rate: float) -> DataFrame:
    """``level`` and ``goal`` for the tokens that ``rate`` keeps of ``target_levels``.

    A level cannot keep more than it holds: where its goal asks for more, the
    others share the rest in proportion to theirs.
    """
    wished = stage(goals.select("level", "goal", "held"), "goals")
    scale, full = float(rate), F.lit(False)
    while True:
        # Levels that are full keep all they hold; what is left of the rate goes to the others.
        now = F.when(full, F.col("held")).otherwise(F.col("goal") * scale)
        over = ~full & (now > F.col("held"))
        row = wished.agg(
            F.count_if(over).alias("n"),
            (rate * F.sum("goal") - F.sum(F.when(full | over, F.col("held")))).alias("left"),
            F.sum(F.when(~(full | over), F.col("goal"))).alias("goal"),
        ).first()
        if not row["n"] or not row["goal"]:
            return wished.select("level", F.least(now, F.col("held").cast("double")).alias("goal"))
        # Scales only grow, so that a level that is full stays full.
        full = F.col("goal") * scale > F.col("held")
        scale = row["left"] / row["goal"]


def calibrate(
    weighed: DataFrame,
    targets: Sequence[Target] = TARGETS,
    rate: float = 0.6,
    iterations: int = 2000,
    tolerance: float = 1e-4,
) -> DataFrame:
    """Add ``probability``: at most 1, and the expected tokens meet every target's share of ``rate``.

    ``weighed`` comes from ``rake`` and gives the start. Where a level must
    gain, its cells at probability 1 are fixed and the others scaled; where it
    must lose, all are. Sweeps over the targets end when none is off by more
    than ``tolerance``; targets that no probabilities meet together are only
    approached. Cells without tokens get ``rate``.

    Cells are sums of documents. Up to ``BROADCAST_CELLS`` of them are swept on
    the driver, more by a grouped sum and a join per target and sweep. Both make
    the same sweeps under the same limits, so the number of cells decides where
    they are swept and never the result.
    """
    if rate >= 1:
        return weighed.withColumn("probability", F.lit(1.0))
    columns = [t.column for t in targets]
    start = F.coalesce(F.least(F.lit(1.0), F.col("weight") * F.lit(float(rate))), F.lit(float(rate)))
    first = weighed.withColumn("probability", F.when(start < AT_BOUND, start).otherwise(1.0))
    goals = [kept_goals(target_levels(weighed, t), rate) for t in targets]
    if weighed.count() > BROADCAST_CELLS:
        return _swept(first, columns, goals, iterations, tolerance)
    cells = first.orderBy(*columns).collect()
    wished = [{row["level"]: row["goal"] for row in goal.collect()} for goal in goals]
    chances = bounded_fit(
        [r["tokens"] for r in cells],
        [[r[c] for c in columns] for r in cells],
        [r["probability"] for r in cells],
        wished,
        iterations,
        tolerance,
    )
    rows = [(*r[:-1], p) for r, p in zip(cells, chances)]
    return weighed.sparkSession.createDataFrame(rows, first.schema)


def bounded_fit(
    tokens: Sequence[int],
    levels: Sequence[Sequence[str]],
    chances: Sequence[float],
    goals: Sequence[Mapping[str, float]],
    iterations: int,
    tolerance: float,
) -> list[float]:
    """Probabilities of cells, raked to ``goals`` (per target by level) under the bound of 1.

    Levels are added up in whole numbers, whose order does not matter: every
    sum, and so every probability, has the same bits as in ``_swept``.
    """
    tokens, chances = np.array(tokens, np.int64), np.array(chances, float)
    members = []
    for k, goal in enumerate(goals):
        place: dict[str, int] = {}
        mine = [i for i, own in enumerate(levels) if tokens[i] and own[k] in goal]
        level = np.array([place.setdefault(levels[i][k], len(place)) for i in mine], np.int64)
        members.append((np.array(mine, np.int64), level, np.array([goal[x] for x in place], float)))
    for _ in range(iterations):
        worst = 0.0
        for mine, level, goal in members:
            held, own = tokens[mine], chances[mine]
            bound = own >= 1

            def summed(values: np.ndarray, level: np.ndarray = level, n: int = len(goal)) -> np.ndarray:
                out = np.zeros(n, np.int64)
                np.add.at(out, level, values.astype(np.int64))
                return out.astype(float)

            fixed = summed(np.where(bound, held, 0))
            whole, first, second = map(summed, _parts(np.where(bound, 0.0, held * own), np.floor))
            free = whole + (first + second / PART) / PART
            total = fixed + free
            gains = total < goal
            worst = max(worst, (np.abs(total - goal) / goal).max(initial=0.0))
            # Cells that other targets hold at 0 stay there.
            up = np.divide(goal - fixed, free, out=np.ones(len(goal)), where=free > 0)
            down = np.divide(goal, total, out=np.ones(len(goal)), where=total > 0)
            chance = own * np.where(gains, up, down)[level]
            chances[mine] = np.where(gains[level] & bound, own, np.where(chance < AT_BOUND, chance, 1.0))
        if worst < tolerance:
            break
    return chances.tolist()


def _parts(tokens, floor: Callable) -> tuple:
    """``tokens`` as whole ones and two parts of ``PART`` to one, all whole numbers; what is less goes."""
    whole = floor(tokens)
    rest = (tokens - whole) * PART
    first = floor(rest)
    return whole, first, floor((rest - first) * PART)


def _swept(
    first: DataFrame, columns: Sequence[str], goals: Sequence[DataFrame], sweeps: int, tolerance: float
) -> DataFrame:
    """``bounded_fit`` of many cells; a sweep is written out, and deleted when it is no longer read."""
    spark, path = first.sparkSession, scratch_path(first.sparkSession, "sweeps")
    # A cell brings its levels' goals along, so that a sweep does not join them again.
    for i, (column, goal) in enumerate(zip(columns, goals)):
        own = goal.select(F.col("level").alias("_level"), F.col("goal").alias(f"_goal{i}"))
        start = (start if i else first).join(own, F.col(column) == F.col("_level"), "left").drop("_level")
    start.write.parquet(f"{path}/0")
    fitted = spark.read.schema(start.schema).parquet(f"{path}/0")
    at_bound, expected = F.col("probability") >= 1, F.col("tokens") * F.col("probability")
    whole, first_part, second_part = _parts(F.when(at_bound, 0.0).otherwise(expected), F.floor)
    fixed = F.col("_fixed").cast("double")
    free = F.col("_whole") + (F.col("_first") + F.col("_second") / PART) / PART
    total = fixed + free
    for n in range(1, sweeps + 1):
        moved = fitted.withColumn("_off", F.lit(0.0))
        for i, column in enumerate(columns):
            goal = F.col(f"_goal{i}")
            sums = moved.groupBy(F.col(column).alias("_level")).agg(
                F.sum(F.when(at_bound, F.col("tokens")).otherwise(0)).alias("_fixed"),
                F.sum(whole).alias("_whole"),
                F.sum(first_part).alias("_first"),
                F.sum(second_part).alias("_second"),
            )
            gains = total < goal
            up = F.coalesce(F.try_divide(goal - fixed, free), F.lit(1.0))
            chance = F.col("probability") * F.when(gains, up).otherwise(F.try_divide(goal, total))
            moved = moved.join(sums, F.col(column) == F.col("_level"), "left").withColumns(
                {
                    "_off": F.greatest("_off", F.try_divide(F.abs(total - goal), goal)),
                    "probability": F.when(goal.isNull() | (F.col("tokens") == 0), F.col("probability"))
                    .when(gains & at_bound, F.col("probability"))
                    .otherwise(F.when(chance < AT_BOUND, chance).otherwise(1.0)),
                }
            )
            moved = moved.select(*start.columns, "_off")
        moved.write.parquet(f"{path}/{n}")
        fitted = spark.read.schema(moved.schema).parquet(f"{path}/{n}")
        off = fitted.agg(F.max("_off")).first()[0] or 0.0
        fitted = fitted.drop("_off")
        discard(spark, f"{path}/{n - 1}")
        if off < tolerance:
            break
    return fitted.select(*first.columns)


def thresholds(rows: DataFrame, cells: DataFrame, levels: Sequence[str], seed: int = 7) -> DataFrame:
    """Per cell the hash below which its documents are sampled, as ``threshold``.

    Documents in order of ``draw`` fill the cell's share of tokens. The bin of
    hashes in which it is reached is counted anew in finer bins; the last one,
    a document as a rule, is in by chance, so that a cell keeps its share on average.
    Only sums per cell and bin travel, however many documents a cell has.
    """
    few = cells.count() <= BROADCAST_CELLS
    keys = [f"_{c}" for c in levels]
    same = [F.col(c) == F.col(f"_{c}") for c in levels]
    now = cells.select(
        *[F.col(c).alias(f"_{c}") for c in levels],
        (F.col("tokens") * F.col("probability")).alias("share"),
        F.lit(0.0).alias("low"),
        F.lit(1.0).alias("width"),
    )
    for _ in range(2):
        known = F.broadcast(now) if few else now
        inside = rows.filter("n_tokens > 0").join(known, same)
        place = F.floor((F.col("draw") - F.col("low")) / F.col("width") * DRAW_BINS)
        inside = inside.select(*keys, place.alias("bin"), "n_tokens").filter(F.col("bin").between(0, DRAW_BINS - 1))
        bins = inside.groupBy(*keys, "bin").agg(F.sum("n_tokens").alias("n"))
        in_order = Window.partitionBy(*keys).orderBy("bin")
        bins = bins.withColumn("before", F.sum("n").over(in_order) - F.col("n"))
        bins = bins.join(now.select(*keys, "share", "low", "width"), keys).filter(F.col("before") < F.col("share"))
        last = bins.groupBy(*keys).agg(
            F.max(F.struct("bin", "before", "n", "share", "low", "width")).alias("at")
        )
        found = last.select(
            *keys,
            (F.col("at.share") - F.col("at.before")).alias("share"),
            F.col("at.n").alias("n"),
            (F.col("at.low") + F.col("at.width") * F.col("at.bin") / DRAW_BINS).alias("low"),
            (F.col("at.width") / DRAW_BINS).alias("width"),
        )
        now = stage(found.coalesce(1) if few else found, "thresholds")
    chance = F.least(F.lit(1.0), F.try_divide("share", "n"))
    taken = unit_hash(*[F.col(k) for k in keys], F.lit(seed)) < chance
    return now.select(*keys, (F.col("low") + F.when(taken, F.col("width")).otherwise(0.0)).alias("threshold"))


def mix(
    docs: DataFrame,
    targets: Sequence[Target] = TARGETS,
    rate: float = 0.6,
    carry: Sequence[str] = ("doc_id",),
    seed: int = 7,
) -> DataFrame:
    """The columns ``carry`` with ``source``, ``lang``, ``topic``, ``n_tokens``, ``weight``,
    ``probability`` and ``sampled``, one row per row of ``docs``.

    Tokens are runs of characters other than ASCII white space. A null level
    counts as "unknown". Texts without tokens have no weight and are sampled
    at ``rate``. The hash depends on id and text only: rows that repeat both
    are decided alike, and a lost task decides the same again. No rows give no
    rows. Columns outside ``carry`` and the four named are not read. The
    columns of the cells come after ``carry`` and may repeat its names: they
    are prefixed ``mix_`` then.
    """
    kept_as = {f"c{i}": name for i, name in enumerate(carry)}
    text = text_or_empty()
    rows = stage(
        docs.select(
            *[F.col(n).alias(k) for k, n in kept_as.items()],
            *[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in ("source", "lang")],
            topic(text).alias("topic"),
            F.regexp_count(text, F.lit(r"[^ \t-\r]+")).cast("bigint").alias("n_tokens"),
            unit_hash(F.col("doc_id"), text_key(), F.lit(seed)).alias("draw"),
        ),
        "mix",
    )
    levels = ["source", "lang", "topic"]
    cells = stage(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "cells")
    weighed = stage(calibrate(stage(rake(cells, targets), "weights"), targets, rate), "chances")
    limits = thresholds(rows, weighed, levels, seed)
    chances = weighed.join(limits, [F.col(c) == F.col(f"_{c}") for c in levels], "left").select(
        *[F.col(c).alias(f"_{c}") for c in levels],
        F.round("weight", 9).alias("weight"),
        F.round("probability", 9).alias("probability"),
        # Without tokens there is no share to fill; at probability 1 everything is in.
        F.when(F.col("probability") >= 1, 1.0).otherwise(F.coalesce("threshold", "probability")).alias("threshold"),
    )
    chances = stage(chances, "sampling")
    # As many cells as sources, so they are sent to every task only if few.
    if weighed.count() <= BROADCAST_CELLS:
        chances = F.broadcast(chances)
    joined = rows.join(chances, [F.col(c) == F.col(f"_{c}") for c in levels])
    limit = F.when(F.col("n_tokens") > 0, F.col("threshold")).otherwise(F.lit(float(rate)))
    return joined.select(
        *[F.col(k).alias(n) for k, n in kept_as.items()],
        *[F.col(c).alias(f"mix_{c}" if c in carry else c) for c in (*levels, "n_tokens", "weight", "probability")],
        (F.col("draw") < limit).alias("mix_sampled" if "sampled" in carry else "sampled"),
    )


def sampled(docs: DataFrame, targets: Sequence[Target] = TARGETS, rate: float = 0.6, seed: int = 7) -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    rows = mix(docs, targets, rate, carry=docs.columns, seed=seed)
    flag = "mix_sampled" if "sampled" in docs.columns else "sampled"
    return rows.filter(F.col(flag)).select(*docs.columns)
