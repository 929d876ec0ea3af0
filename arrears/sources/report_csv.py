"""Reports as headed CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from arrears.schemas import BALANCE_DATE, COUNT_REPORT, REPORT, REPORT_COLUMNS

# The date styles found in saved reports.
DATE_STYLES = ("yyyy-MM-dd", "dd-MM-yyyy")


def export_raw_csv(report: DataFrame, path: str) -> None:
    """Write a report of either layout as one CSV file with a header.

    A report has one row per balance date, so one file is the right size.
    """
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_raw_reports(spark: SparkSession, paths: str | list[str], with_files: bool = False) -> DataFrame:
    """Read saved reports of either date style; a foreign header or value fails.

    ``with_files`` adds ``saved_at`` and ``saved_in``, the modification time
    and path of the file each row came from.
    """
    as_text = StructType([StructField(BALANCE_DATE, StringType()), *REPORT.fields[1:]])
    raw = _reader(spark, as_text).csv(paths)
    columns = [_saved_date(BALANCE_DATE), *REPORT_COLUMNS[1:]]
    return raw.select(*columns, *(file_columns() if with_files else []))


def read_raw_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Read saved count reports, which carry no date column."""
    return _reader(spark, StructType(COUNT_REPORT.fields[1:])).csv(paths)


def file_columns() -> list[Column]:
    return [
        F.col("_metadata.file_modification_time").alias("saved_at"),
        F.col("_metadata.file_path").alias("saved_in"),
    ]


def _reader(spark: SparkSession, schema: StructType):
    return spark.read.schema(schema).options(header="true", enforceSchema="false", mode="FAILFAST")


def _saved_date(name: str) -> Column:
    parsed = [F.try_to_date(F.col(name), style) for style in DATE_STYLES]
    message = F.concat(F.lit("not a balance date: "), F.coalesce(F.col(name), F.lit("null")))
    return F.coalesce(*parsed, F.raise_error(message).cast("date")).alias(name)
