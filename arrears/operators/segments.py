"""Segments of the portfolio and their totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.schemas import BALANCE_DATE, SEGMENT_COLUMNS

FLAGS = ("has_first", "defaulted_first", "has_later", "defaulted_later", "in_cohort", "is_over", "is_fraud")
AMOUNTS = ("total", "outstanding", "outstanding_over")


@dataclass(frozen=True)
class Segment:
    """Who is observed, who counts as defaulted and what they owe."""

    observed: str
    defaulted: str
    owed: str


def segments(fraud_mode: str) -> dict[str, Segment]:
    """The five segments, in report order."""
    fraud = "has_first and is_fraud" if fraud_mode == "only" else "has_first and not is_fraud"
    by_name = {
        "first_payment": Segment("has_first", "defaulted_first", "outstanding"),
        "second_plus": Segment("has_later", "defaulted_later", "outstanding"),
        "overall_90plus": Segment("has_first", "is_over", "outstanding_over"),
        "fraud_90plus": Segment(fraud, "is_over", "outstanding_over"),
        "cohort_90plus": Segment("has_first and in_cohort", "is_over", "outstanding_over"),
    }
    return {name: by_name[name] for name in SEGMENT_COLUMNS}


def segment_totals(rows: DataFrame, balance_dates: Sequence[date], chosen: dict[str, Segment]) -> DataFrame:
    """One row per balance date with four measures per segment.

    ``rows`` holds one row per date and loan, so distinct counts are plain
    conditional counts. Dates without any loan appear too, with counts of 0
    and null amounts, as a global aggregate would give.
    """
    every_date = _empty_rows(rows.sparkSession, balance_dates)
    measures = [measure for name, segment in chosen.items() for measure in _measures(name, segment)]
    used = [name for name in (*FLAGS, *AMOUNTS) if name in rows.columns]
    return (
        rows.select(BALANCE_DATE, *used)
        .unionByName(every_date.select(BALANCE_DATE, *used))
        .groupBy(BALANCE_DATE)
        .agg(*measures)
    )


def _empty_rows(spark: SparkSession, balance_dates: Sequence[date]) -> DataFrame:
    """One row per balance date that belongs to no segment."""
    days = F.explode(F.array(*[F.lit(day) for day in balance_dates])).alias(BALANCE_DATE)
    flags = [F.lit(False).alias(name) for name in FLAGS]
    amounts = [F.lit(None).alias(name) for name in AMOUNTS]
    return spark.range(0, 1, 1, 1).select(days, *flags, *amounts)


def _measures(name: str, segment: Segment) -> list[Column]:
    owed = f"if({segment.defaulted}, {segment.owed}, 0)"
    measures = {
        "defaulted": f"count_if({segment.observed} and {segment.defaulted})",
        "observed": f"count_if({segment.observed})",
        "outstanding": f"sum(if({segment.observed}, {owed}, null))",
        "total": f"sum(if({segment.observed}, total, null))",
    }
    return [F.expr(f"{measure} as {name}_{kind}") for kind, measure in measures.items()]
