"""One row per balance date and observed loan, with every flag a report needs.

Each source is reduced to one row per loan by its own grouping before any
join. The groupings combine on the map side, so a loan (or copied key) that
holds a large share of a source costs one row per map task in the shuffle, and
the joins that follow meet unique keys only and reuse the partitioning of the
groupings.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.config import ReportConfig
from arrears.functions import predicates as p
from arrears.functions.amounts import or_zero
from arrears.operators.loan_sets import fraud_accounts
from arrears.schemas import BALANCE_DATE, LOAN
from arrears.session import require_utc
from arrears.sources.tables import FRAUD_LOAN, LoanBook

# What makes up a snapshot row's total amount.
TOTAL_PARTS = ("Loan_Principal", "Loan_Interest", "Overdue_Penalty", "Loan_Fee")


def installment_milestones(installments: DataFrame, last_date: date) -> DataFrame:
    """The earliest due date per loan of each kind of installment.

    "Has such an installment due by day X" only ever turns from false to true
    as X grows, so these four dates answer it for every X up to ``last_date``
    and a backfill does not multiply installments by its dates.
    """
    due = F.col("installmentDueDate")
    first, later, delinquent = p.first_installment(), p.later_installment(), p.ever_delinquent()
    return (
        installments.filter(p.due_by(last_date) & (first | later))
        .groupBy(LOAN)
        .agg(
            F.min(F.when(first, due)).alias("first_due"),
            F.min(F.when(first & delinquent, due)).alias("first_default_due"),
            F.min(F.when(later, due)).alias("later_due"),
            F.min(F.when(later & delinquent, due)).alias("later_default_due"),
        )
    )


def loan_standing(loans: DataFrame, config: ReportConfig) -> DataFrame:
    """Active loans and whether they belong to the disbursement cohort.

    Grouped because the master may repeat a loan, which must not multiply
    snapshot rows. A loan is active or in the cohort if any row says so.
    """
    return (
        loans.filter(p.disbursed())
        .groupBy(LOAN)
        .agg(
            F.bool_or(p.still_open(config.closed_statuses)).alias("is_active"),
            F.bool_or(p.disbursed_in(config.cohort_year)).alias("in_cohort"),
        )
        .filter("is_active")
        .select(LOAN, _known("in_cohort"))
    )


def snapshot(buckets: DataFrame, balance_dates: Sequence[date]) -> DataFrame:
    """Bucket rows of the balance dates; prunes partitions of ``bucketDate``.

    The range beside the list reaches the scan also where the column is stored
    as a timestamp, for which a list of dates is not pushed.
    """
    day = F.col("bucketDate")
    listed = buckets.filter(day.isin(*balance_dates))
    if len(balance_dates) == 1:
        return listed
    return listed.filter(day.between(F.lit(min(balance_dates)), F.lit(max(balance_dates))))


def snapshot_by_loan(buckets: DataFrame, balance_dates: Sequence[date], dpd_threshold: int) -> DataFrame:
    """Amounts per balance date and loan; a loan's repeated rows add up."""
    parts = [or_zero(F.col(name)) for name in TOTAL_PARTS]
    rows = snapshot(buckets, balance_dates).select(
        LOAN,
        F.col("bucketDate").alias(BALANCE_DATE),
        reduce(add, parts).alias("total"),
        or_zero(F.col("Total_Outstanding_Amount")).alias("outstanding"),
        p.past_due_over(dpd_threshold).alias("over"),
    )
    return rows.groupBy(*_row_keys(balance_dates)).agg(
        F.sum("total").alias("total"),
        F.sum("outstanding").alias("outstanding"),
        F.bool_or("over").alias("is_over"),
        F.sum(F.when(F.col("over"), F.col("outstanding")).otherwise(0)).alias("outstanding_over"),
    )


def observed_loans(book: LoanBook, config: ReportConfig, with_fraud: bool = True) -> DataFrame:
    """Active loans with a due installment, per balance date, with their flags."""
    dates = config.balance_dates
    day = F.lit(dates[0]) if len(dates) == 1 else F.explode(F.array(*[F.lit(d) for d in dates]))

    def reached(milestone: str) -> Column:
        return F.coalesce(F.col(milestone) <= F.col(BALANCE_DATE), F.lit(False))

    loans = loan_standing(book.loans, config).join(
        installment_milestones(book.installments, dates[-1]), LOAN
    )
    if with_fraud:
        loans = mark_fraud(loans, book.fraud)
    return (
        loans.withColumn(BALANCE_DATE, day)
        .select(
            LOAN,
            BALANCE_DATE,
            reached("first_due").alias("has_first"),
            reached("first_default_due").alias("defaulted_first"),
            reached("later_due").alias("has_later"),
            (reached("later_default_due") & ~reached("first_default_due")).alias("defaulted_later"),
            "in_cohort",
            *(["is_fraud"] if with_fraud else []),
        )
        .filter("has_first or has_later")
    )


def mark_fraud(loans: DataFrame, fraud: DataFrame) -> DataFrame:
    """Add ``is_fraud``: the loan number, read as an integer, is in the list.

    The flag is null where the loan number is not an integer. The list carries
    no broadcast hint: Spark broadcasts it while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond.
    Neither side repeats a key.
    """
    number = F.col(LOAN).try_cast("bigint")
    listed = fraud_accounts(fraud)
    return (
        loans.withColumn("loan_as_number", number)
        .join(listed, F.col("loan_as_number") == F.col(FRAUD_LOAN), "left")
        .withColumn("is_fraud", F.when(F.col("loan_as_number").isNotNull(), F.col(FRAUD_LOAN).isNotNull()))
        .drop("loan_as_number", FRAUD_LOAN)
    )


def loan_rows(book: LoanBook, config: ReportConfig, with_fraud: bool = True) -> DataFrame:
    """Observed loans in the snapshot of each balance date, with flags and amounts."""
    require_utc(book.loans.sparkSession)
    dates = config.balance_dates
    amounts = snapshot_by_loan(book.buckets, dates, config.dpd_threshold)
    rows = amounts.join(observed_loans(book, config, with_fraud), _row_keys(dates), "inner")
    if config.strict_loan_numbers and with_fraud:
        # Checked here and not in the lookup: only loans that the fraud
        # segment observes may fail on their number.
        message = F.concat(F.lit("loan number is not an integer: "), F.col(LOAN))
        unknown = F.when(F.col("has_first"), F.raise_error(message).cast("boolean"))
        rows = rows.withColumn("is_fraud", F.coalesce("is_fraud", unknown))
    return rows.withColumn("is_fraud", F.coalesce("is_fraud", F.lit(False))) if with_fraud else rows


def _row_keys(balance_dates: Sequence[date]) -> list[str]:
    """What identifies a loan row in the groupings and the join.

    For one date that is the loan, the key that the other sources are shuffled
    by. For several dates the snapshot is shuffled once by loan and date, and
    the observed loans, which are fewer and narrower, follow it there.
    """
    return [LOAN] if len(balance_dates) == 1 else [LOAN, BALANCE_DATE]


def _known(flag: str) -> Column:
    return F.coalesce(F.col(flag), F.lit(False)).alias(flag)
