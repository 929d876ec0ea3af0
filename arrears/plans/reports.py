"""Reports: one row per balance date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.config import ReportConfig
from arrears.functions import predicates as p
from arrears.operators.loan_rows import installment_milestones, loan_rows
from arrears.operators.loan_sets import active_loans
from arrears.operators.segments import segment_totals, segments
from arrears.schemas import BALANCE_DATE, LOAN, SEGMENT_COLUMNS
from arrears.session import require_utc
from arrears.sources.tables import LoanBook

# Columns of a report on one segment.
SEGMENT_MEASURES = (
    "defaulted",
    "observed",
    "default_rate",
    "outstanding_amount",
    "total_amount",
    "amount_rate",
)

# Column names of the population diagnostics.
SIZE_COLUMNS = ("activeloans", "installmentone", "installmentonedefault")


def segment_report(book: LoanBook, config: ReportConfig, name: str) -> DataFrame:
    """Counts, amounts and rates of one segment."""
    chosen = segments(config.fraud_mode)[name]
    rows = loan_rows(book, config, with_fraud=name == "fraud_90plus")
    totals = segment_totals(rows, config.balance_dates, {name: chosen})
    return totals.selectExpr(BALANCE_DATE, *_segment_columns(name, SEGMENT_MEASURES))


def full_report(book: LoanBook, config: ReportConfig) -> DataFrame:
    """All five segments by count and by amount: 31 columns.

    Several offsets in ``config.months_back`` fill in past months in one job.
    Only due dates and the snapshot move with the balance date; delinquency
    and loan status are read as they are now.
    """
    return _report(book, config, names_per_segment=6)


def count_report(book: LoanBook, config: ReportConfig) -> DataFrame:
    """All five segments by count only: 16 columns."""
    return _report(book, config, names_per_segment=3)


def segment_sizes(book: LoanBook, config: ReportConfig) -> DataFrame:
    """Per balance date: rows of active loans, loans with a due, or defaulted, first installment.

    Active loans are counted as they are now, so their number is the same for
    every date; the rest compares each loan's earliest due dates with the date.
    """
    require_utc(book.loans.sparkSession)
    dates = config.balance_dates
    active = active_loans(book.loans, config.closed_statuses).agg(F.count(LOAN).alias("active"))
    first = installment_milestones(book.installments.filter(p.first_installment()), dates[-1])
    reached = [
        F.count_if(F.col(due) <= F.lit(day)).alias(f"{due}_{i}")
        for i, day in enumerate(dates)
        for due in ("first_due", "first_default_due")
    ]
    both = active.unionByName(first.agg(*reached), allowMissingColumns=True)
    sums = both.agg(*[F.sum(name).alias(name) for name in both.columns])
    rows = [
        F.struct(
            F.lit(day).alias(BALANCE_DATE),
            F.col("active").alias(SIZE_COLUMNS[0]),
            F.col(f"first_due_{i}").alias(SIZE_COLUMNS[1]),
            F.col(f"first_default_due_{i}").alias(SIZE_COLUMNS[2]),
        )
        for i, day in enumerate(dates)
    ]
    return sums.select(F.inline(F.array(*rows)))


def preview(report: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows, newest balance date first."""
    return report.orderBy(F.desc(BALANCE_DATE)).limit(rows)


def _report(book: LoanBook, config: ReportConfig, names_per_segment: int) -> DataFrame:
    rows = loan_rows(book, config)
    totals = segment_totals(rows, config.balance_dates, segments(config.fraud_mode))
    columns = [
        column
        for name, names in SEGMENT_COLUMNS.items()
        for column in _segment_columns(name, names)[:names_per_segment]
    ]
    return totals.selectExpr(BALANCE_DATE, *columns)


def _segment_columns(segment: str, names: tuple[str, ...]) -> list[str]:
    """The six columns of a segment from its totals; a rate over 0 is null."""
    defaulted, observed = f"{segment}_defaulted", f"{segment}_observed"
    outstanding, total = f"double({segment}_outstanding)", f"double({segment}_total)"
    values = (
        defaulted,
        observed,
        f"try_divide({defaulted}, {observed})",
        outstanding,
        total,
        f"try_divide({outstanding}, {total})",
    )
    return [f"{value} as {name}" for value, name in zip(values, names)]
