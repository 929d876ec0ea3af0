"""What each of five filters removes, alone and in every order.

Four conditions look at one text: A few words, B repetitive words, C many
capitals, D symbols. The fifth, E, asks whether a row with a smaller id has the
same text: an existential self-join, written as a left semi join on the hash,
the exact text and a smaller id. Its ids are united with the other failures,
and rows are counted by their combination of failed filters. Thirty-two counts
a part then say what any order of the filters removes at any step.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.frames import text_or_empty, words
from arrears.sources.scratch import stage

# A filter's bit is its place in this text.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")

_KEY = ["doc_id", "part", "h1", "h2"]


def own_failures(text: Column) -> Column:
    """The bits of A to D for a text that is not null."""
    n = F.size("_words")
    failed = {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct("_words")) < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    bits = F.lit(0)
    for name, condition in failed.items():
        bits = bits + F.when(condition, 1 << FILTERS.index(name)).otherwise(0)
    return bits


def _keyed(docs: DataFrame, part: str) -> DataFrame:
    """Rows with the columns of ``_KEY`` and ``text``; two hashes with different seeds name a text."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
        text.alias("text"),
    )


def copies(docs: DataFrame, facts: DataFrame, part: str = "lang") -> DataFrame:
    """The keys of rows whose text a smaller id has too.

    Only hashes that two different ids have can matter, and only their rows
    carry text further. One row per text, its smallest id, stands for all
    smaller ids on the right side of the semi join; a group of copies is
    combined on the map side there and may be split on the left.
    """
    named = facts.filter("doc_id IS NOT NULL")
    shared = named.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = stage(shared.filter("low < high").select("h1", "h2"), "shared")
    texts = _keyed(docs, part).filter("doc_id IS NOT NULL").join(shared, ["h1", "h2"], "left_semi")
    texts = stage(texts, "suspects")
    firsts = texts.groupBy("h1", "h2", "text").agg(F.min("doc_id").alias("first"))
    firsts = stage(firsts.toDF("_h1", "_h2", "_text", "first"), "firsts")
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("text") == F.col("_text"))
    return texts.join(firsts, same & (F.col("first") < F.col("doc_id")), "left_semi").select(*_KEY)


def combinations(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part``, ``bits`` (failed filters), ``n``, ``good`` and ``toxic`` rows.

    Null texts count as empty, a null part as the empty string. Rows without
    an id are copies of nothing, make no copies and have no labels. Rows that
    repeat an id count each; several labels of one id hold if any of them does.
    """
    rows = _keyed(docs, part).withColumn("_words", words(F.col("text")))
    facts = stage(rows.select(*_KEY, own_failures(F.col("text")).alias("bits")), "failures")
    # Rows of one key have one text, so A to D agree on them; marks of E add no rows.
    counted = facts.groupBy(*_KEY).agg(F.first("bits").alias("bits"), F.count("*").alias("n"))
    marked = copies(docs, facts, part).select(*_KEY, F.lit(COPY).alias("bits"), F.lit(0).cast("bigint").alias("n"))
    united = counted.unionByName(marked).groupBy(*_KEY).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))

    def any_one(column: str) -> Column:
        return F.max(F.when(F.col(column) == 1, 1).otherwise(0))

    flags = labels.groupBy(F.col("doc_id").cast("bigint").alias("_id"))
    flags = flags.agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic"))
    joined = united.join(flags, F.col("doc_id") == F.col("_id"), "left")

    def rows_with(flag: str) -> Column:
        return F.sum(F.col("n") * F.coalesce(flag, F.lit(0))).alias(flag)

    return joined.groupBy("part", "bits").agg(F.sum("n").alias("n"), rows_with("good"), rows_with("toxic"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; see ``combinations`` for odd rows.

    ``kept`` rows pass all filters up to the step, ``removed`` fail this one
    first, ``redundant`` fail it too but went earlier, ``unique_fails`` fail it
    alone. ``good_lost`` and ``toxic_lost`` are removed rows with that label,
    ``shapley`` sums the filter's removals over all orders. No rows give none.
    """
    counts = stage(combinations(docs, labels, part), "combinations")
    # 600 rows for each of at most 32 combinations a part, whatever the input.
    steps = counts.withColumn("_step", F.explode(F.split(F.lit(" ".join(_steps())), " ")))
    field = F.split("_step", ":")
    steps = steps.select(
        "part", "bits", "n", "good", "toxic", field[0].alias("filter_order"),
        *[field[i].cast("int").alias(name) for i, name in enumerate(("step", "_bit", "_before"), 1)],
    )
    fails = F.col("bits").bitwiseAND(F.col("_bit")) != 0
    gone = F.col("bits").bitwiseAND(F.col("_before")) != 0

    def total(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("bigint")

    sums = steps.groupBy("part", "filter_order", "step", "_bit").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("bits") == F.col("_bit")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    of_filter = Window.partitionBy("part", "_bit")
    return sums.withColumn("shapley", F.sum("removed").over(of_filter)).drop("_bit")


def _steps() -> list[str]:
    """Order, step, bit of the step's filter and bits of the filters before it, of every order."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append(f"{''.join(order)}:{step}:{bit}:{before}")
            before |= bit
    return out


ORACLE = r"""
WITH facts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
failed AS (
  SELECT doc_id, part,
    (len(w) < 100) AS a, (100 * len(list_distinct(w)) < 80 * len(w)) AS b,
    (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e
  FROM facts),
flags AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
rows AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM failed LEFT JOIN flags USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
judged AS (
  SELECT *, contains(fails, letter) AS hit, translate(fails, earlier, '') <> fails AS gone FROM rows, steps),
sums AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM sums
"""
