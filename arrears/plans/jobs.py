"""Jobs that write: the monthly run, the rebuild and the summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.config import ReportConfig
from arrears.plans.reports import full_report
from arrears.schemas import BALANCE_DATE, REPORT_COLUMNS
from arrears.sources.history import prepare_append, prepare_upsert, read_history, rebuild_history
from arrears.sources.report_csv import export_raw_csv, read_raw_reports
from arrears.sources.scratch import staged
from arrears.sources.tables import LoanBook

HISTORY_WRITERS = {"upsert": prepare_upsert, "append": prepare_append}


def monthly_run(
    book: LoanBook, config: ReportConfig, history: str, csv: str, into_history: str = "upsert"
) -> DataFrame:
    """Compute the report once, add it to the history and save it as CSV.

    The history changes last and at once: a run that stops earlier, also
    between the two, leaves it as it was and can be repeated. Returns the
    report as the CSV holds it.
    """
    prepare = HISTORY_WRITERS[into_history]
    with staged(full_report(book, config), "monthly") as report:
        commit = prepare(report, history)
        export_raw_csv(report, csv)
        commit()
    return read_raw_reports(report.sparkSession, csv)


def rebuild(book: LoanBook, config: ReportConfig, history: str) -> None:
    """Replace the history with the months of ``config``, computed in one job.

    The old months count until the new ones are stored whole.
    """
    with staged(full_report(book, config), "rebuild") as report:
        rebuild_history(report, history)


def monthly_summary(
    spark: SparkSession, csv: str | list[str] | None = None, history: str | None = None
) -> DataFrame:
    """All saved months in one table, newest first.

    Where a balance date was saved more than once, the newest file counts.
    """
    saved = []
    if csv is not None:
        saved.append(read_raw_reports(spark, csv, with_files=True))
    if history is not None:
        saved.append(read_history(spark, history, with_files=True))
    if not saved:
        raise ValueError("name a CSV path, a history path or both")

    # The row itself comes last in the order so that equal ages cannot make
    # the outcome depend on which row is read first.
    newest = F.max(F.struct("saved_at", "saved_in", F.struct(*REPORT_COLUMNS[1:]).alias("row")))
    return (
        reduce(DataFrame.unionByName, saved)
        .groupBy(BALANCE_DATE)
        .agg(newest.alias("newest"))
        .select(BALANCE_DATE, "newest.row.*")
        .orderBy(F.desc(BALANCE_DATE))
    )
