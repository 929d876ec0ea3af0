"""Preference formatting: a shared prompt and a pair of masked completions.

Of a chosen and a rejected conversation the longest common prefix of turns is
rendered once, as the prompt; what follows is rendered per side. The result
has one row per rendered turn, so a conversation of any length stays spread
out. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands around a turn; ``{role}`` is replaced."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    trained: str = "assistant"

    def header(self, role: Column) -> Column:
        return F.replace(F.lit(self.before), F.lit("{role}"), role)


def degraded(turns: DataFrame) -> DataFrame:
    """A rejected side for conversations that have none.

    One assistant turn loses the second half of its characters and ends the
    conversation: the last one for an even ``conv_id``, else the first. A
    conversation without assistant turns comes back whole.
    """
    answers = turns.filter("role = 'assistant'").groupBy("conv_id").agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
    cut = answers.select(
        F.col("conv_id").alias("_conv"), F.when(F.col("conv_id") % 2 == 0, F.col("b")).otherwise(F.col("a")).alias("cut")
    )
    half = F.substring("text", F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    return (
        turns.join(cut, F.col("conv_id") == F.col("_conv"), "left")
        .filter("cut IS NULL OR turn <= cut")
        .select("conv_id", "turn", "role", F.when(F.col("turn") == F.col("cut"), half).otherwise(F.col("text")).alias("text"))
    )


def preference_pairs(
    chosen: DataFrame, rejected: DataFrame, pair_id: str = "conv_id", template: Template = Template()
) -> DataFrame:
    """One row per rendered turn: ``pair_id``, ``section`` (prompt, chosen or
    rejected), ``turn``, ``role``, ``header``, ``body``, ``footer``, ``trained``.

    Both inputs have the pair's id, ``turn``, ``role``, ``text``; other columns
    are not read. A section's rows in order of ``turn``, concatenated, are its
    text. ``trained`` says whether body and footer count in the loss: in
    completions, for the template's trained role; headers never do.

    Turns are compared by role and text, null equal to null only. A null role
    renders as "unknown", a null text as empty. Rows without an id or a turn
    take no part; of rows that repeat a turn the smallest by role and text
    counts. Equal sides are prompt only; a pair with one side has no common
    turn, and all of it is that side's completion.
    """

    def side(frame: DataFrame, name: str) -> DataFrame:
        # In a struct nulls compare, and a missing turn is told from an empty one.
        content = F.struct("role", "text")
        return frame.select(
            F.col(pair_id).alias("pair_id"),
            "turn",
            F.when(F.lit(name == "chosen"), content).alias("chosen"),
            F.when(F.lit(name == "rejected"), content).alias("rejected"),
        )

    both = side(chosen, "chosen").unionByName(side(rejected, "rejected")).filter("pair_id IS NOT NULL AND turn IS NOT NULL")
    turns = both.groupBy("pair_id", "turn").agg(F.min("chosen").alias("chosen"), F.min("rejected").alias("rejected"))
    same = F.col("chosen").eqNullSafe(F.col("rejected"))
    # Sums and minima per pair combine on the map side; the join back may be split where a pair is hot.
    cuts = turns.groupBy("pair_id").agg(F.min(F.when(~same, F.col("turn"))).alias("cut"))
    joined = turns.join(cuts.withColumnRenamed("pair_id", "_pair"), F.col("pair_id") == F.col("_pair"))
    shared = F.coalesce(F.col("turn") < F.col("cut"), F.lit(True))

    def piece(section: str, content: str) -> Column:
        return F.struct(F.lit(section).alias("section"), F.col(content).alias("content"))

    pieces = F.when(shared, F.array(piece("prompt", "chosen"))).otherwise(
        F.array(piece("chosen", "chosen"), piece("rejected", "rejected"))
    )
    role = F.coalesce("piece.content.role", F.lit("unknown"))
    return (
        joined.select("pair_id", "turn", F.explode(pieces).alias("piece"))
        .filter("piece.content IS NOT NULL")
        .select(
            "pair_id",
            "piece.section",
            "turn",
            role.alias("role"),
            template.header(role).alias("header"),
            F.coalesce("piece.content.text", F.lit("")).alias("body"),
            F.lit(template.after).alias("footer"),
            ((F.col("piece.section") != "prompt") & (role == template.trained)).alias("trained"),
        )
    )


ORACLE = """
WITH cuts AS (
  SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN max(turn) ELSE min(turn) END AS cut
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id
),
sides AS (
  SELECT c.conv_id, c.turn, c.role, c.text, k.cut,
         CASE WHEN c.turn = k.cut THEN substring(c.text, 1, length(c.text) // 2) ELSE c.text END AS other,
         k.cut IS NULL OR c.turn <= k.cut AS has_other
  FROM conversations c LEFT JOIN cuts k USING (conv_id)
),
first_difference AS (
  SELECT conv_id, min(turn) AS at FROM sides
  WHERE NOT has_other OR text IS DISTINCT FROM other GROUP BY conv_id
),
sections AS (
  SELECT s.conv_id, 'prompt' AS section, s.turn, s.role, s.text AS body
  FROM sides s LEFT JOIN first_difference d USING (conv_id) WHERE d.at IS NULL OR s.turn < d.at
  UNION ALL
  SELECT s.conv_id, 'chosen', s.turn, s.role, s.text
  FROM sides s JOIN first_difference d USING (conv_id) WHERE s.turn >= d.at
  UNION ALL
  SELECT s.conv_id, 'rejected', s.turn, s.role, s.other
  FROM sides s JOIN first_difference d USING (conv_id) WHERE s.turn >= d.at AND s.has_other
)
SELECT conv_id AS pair_id, section, turn, role, '<|im_start|>' || role || chr(10) AS header, body,
       '<|im_end|>' || chr(10) AS footer, section <> 'prompt' AND role = 'assistant' AS trained
FROM sections"""
