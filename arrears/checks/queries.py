"""The registered queries: every operator and job on the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.checks.mapped import COHORT_YEAR, FRAUD_KEY, MONTH_ENDS, RUN_DATE, loan_book, read_table
from arrears.config import ReportConfig
from arrears.functions.dates import balance_date
from arrears.operators.loan_sets import active_loans, cohort_loans, fraud_accounts, installment_balances
from arrears.plans.jobs import monthly_run, monthly_summary, rebuild
from arrears.plans.reports import count_report, full_report, preview, segment_report, segment_sizes
from arrears.schemas import BALANCE_DATE, LOAN, REPORT_COLUMNS
from arrears.sources.history import append_history, read_history, upsert_history
from arrears.sources.report_csv import export_raw_csv, read_raw_counts, read_raw_reports
from arrears.sources.scratch import scratch_path, stage
from arrears.sources.tables import LoanBook, load_buckets, load_fraud, load_installments, load_loans

Query = Callable[[SparkSession, str], DataFrame]

LATEST = ReportConfig(run_date=RUN_DATE, cohort_year=COHORT_YEAR)
FOUR_MONTHS = replace(LATEST, months_back=(0, 1, 2, 3))
NEWEST = MONTH_ENDS[-1]


def queries() -> dict[str, Query]:
    only_fraud = replace(LATEST, fraud_mode="only")
    return {
        "balance_dates": balance_dates,
        "inst_first": partial(_balances, kind="first"),
        "inst_first_delinquent": partial(_balances, kind="first_delinquent"),
        "inst_first_current_delinquent": partial(_balances, kind="first_current_delinquent"),
        "inst_second_plus": partial(_balances, kind="second_plus"),
        "inst_second_plus_delinquent": partial(_balances, kind="second_plus_delinquent"),
        "inst_second_plus_current_delinquent": partial(_balances, kind="second_plus_current_delinquent"),
        "active_loans": lambda spark, sf_dir: active_loans(loan_book(spark, sf_dir).loans),
        "cohort_loans": lambda spark, sf_dir: cohort_loans(loan_book(spark, sf_dir).loans, COHORT_YEAR),
        "fraud_accounts": lambda spark, sf_dir: fraud_accounts(loan_book(spark, sf_dir).fraud),
        "kri_first_payment": partial(_segment, name="first_payment", config=LATEST),
        "kri_second_plus": partial(_segment, name="second_plus", config=LATEST),
        "kri_90plus_overall": partial(_segment, name="overall_90plus", config=LATEST),
        "kri_90plus_cohort": partial(_segment, name="cohort_90plus", config=LATEST),
        "kri_90plus_excl_fraud": partial(_segment, name="fraud_90plus", config=LATEST),
        "kri_90plus_only_fraud": partial(_segment, name="fraud_90plus", config=only_fraud),
        "kri_report_counts": partial(_report, build=count_report, config=only_fraud),
        "kri_report_full": partial(_report, build=full_report, config=LATEST),
        "kri_report_full_only_fraud": partial(_report, build=full_report, config=only_fraud),
        "kri_report_from_files": report_from_files,
        "kri_backfill": partial(_report, build=full_report, config=FOUR_MONTHS),
        "kri_backfill_only_fraud": partial(
            _report, build=full_report, config=replace(FOUR_MONTHS, fraud_mode="only")
        ),
        "kri_history_append": history_append,
        "kri_history_rebuild": history_rebuild,
        "kri_history_upsert": history_upsert,
        "kri_monthly_run": run_month,
        "kri_csv_roundtrip": csv_roundtrip,
        "kri_csv_counts": csv_counts,
        "kri_monthly_summary": summary,
        "segment_sizes": partial(_report, build=segment_sizes, config=LATEST),
        "segment_sizes_today": partial(_report, build=segment_sizes, config=None),
        "segment_sizes_by_month": partial(_report, build=segment_sizes, config=FOUR_MONTHS),
        "report_preview": lambda spark, sf_dir: preview(full_report(loan_book(spark, sf_dir), FOUR_MONTHS), 3),
    }


def balance_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order day taken as a run date, with offsets 0 to 3."""
    orders = read_table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("run_date")).distinct()
    offsets = F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("months_back")
    return days.select("run_date", offsets).withColumn(
        BALANCE_DATE, balance_date(F.col("run_date"), F.col("months_back"))
    )


def _balances(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    balances = installment_balances(loan_book(spark, sf_dir).installments, kind, NEWEST)
    amounts = [F.col(name).cast("double").alias(name) for name in ("totalamount", "outstandingamount")]
    return balances.select(LOAN, *amounts)


def _segment(spark: SparkSession, sf_dir: str, name: str, config: ReportConfig) -> DataFrame:
    return segment_report(loan_book(spark, sf_dir), config, name)


def _report(spark: SparkSession, sf_dir: str, build: Callable, config: ReportConfig | None) -> DataFrame:
    """Without a config, as of today."""
    return build(loan_book(spark, sf_dir), config or ReportConfig(cohort_year=COHORT_YEAR))


def report_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full report of a loan book stored in three formats and loaded back."""
    book, path = loan_book(spark, sf_dir), scratch_path(spark, "book")
    book.installments.write.parquet(f"{path}/installments")
    book.loans.write.orc(f"{path}/loans")
    book.buckets.write.partitionBy("bucketDate").parquet(f"{path}/buckets")
    book.fraud.select(FRAUD_KEY).write.option("header", True).csv(f"{path}/fraud")
    loaded = LoanBook(
        installments=load_installments(spark, f"{path}/installments"),
        loans=load_loans(spark, f"{path}/loans", format="orc"),
        buckets=load_buckets(spark, f"{path}/buckets"),
        fraud=load_fraud(spark, f"{path}/fraud", FRAUD_KEY, format="csv"),
    )
    return full_report(loaded, LATEST)


def _staged_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(full_report(loan_book(spark, sf_dir), FOUR_MONTHS), "months")


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three older months, then the newest one appended."""
    history, months = scratch_path(spark, "history"), _staged_months(spark, sf_dir)
    append_history(months.filter(F.col(BALANCE_DATE) < NEWEST), history)
    append_history(months.filter(F.col(BALANCE_DATE) == NEWEST), history)
    return read_history(spark, history)


def history_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history with a doubled month, replaced by a rebuild."""
    history, book = scratch_path(spark, "history"), loan_book(spark, sf_dir)
    newest = stage(full_report(book, LATEST), "newest")
    append_history(newest, history)
    append_history(newest, history)
    rebuild(book, FOUR_MONTHS, history)
    return read_history(spark, history)


def history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months, of which the newest is run again."""
    history, months = scratch_path(spark, "history"), _staged_months(spark, sf_dir)
    upsert_history(months, history)
    upsert_history(months.filter(F.col(BALANCE_DATE) == NEWEST), history)
    return read_history(spark, history)


def run_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly run: what its CSV and its history both hold."""
    history, csv = scratch_path(spark, "history"), scratch_path(spark, "csv")
    monthly_run(loan_book(spark, sf_dir), LATEST, history, csv)
    return read_raw_reports(spark, csv).intersect(read_history(spark, history))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = scratch_path(spark, "csv")
    export_raw_csv(full_report(loan_book(spark, sf_dir), FOUR_MONTHS), csv)
    return read_raw_reports(spark, csv)


def csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count report as saved: without its date."""
    csv = scratch_path(spark, "csv")
    export_raw_csv(count_report(loan_book(spark, sf_dir), LATEST).drop(BALANCE_DATE), csv)
    return read_raw_counts(spark, csv)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months in the history and two in a CSV saved later, which corrects the date in both."""
    history, csv = scratch_path(spark, "history"), scratch_path(spark, "csv")
    months = _staged_months(spark, sf_dir)
    older, newer = F.col(BALANCE_DATE) <= MONTH_ENDS[2], F.col(BALANCE_DATE) >= MONTH_ENDS[2]
    wrong = F.when(F.col(BALANCE_DATE) == MONTH_ENDS[2], F.lit(-1).cast("bigint"))
    count = REPORT_COLUMNS[1]
    upsert_history(months.filter(older).withColumn(count, F.coalesce(wrong, F.col(count))), history)
    export_raw_csv(months.filter(newer), csv)
    return monthly_summary(spark, csv=csv, history=history)
