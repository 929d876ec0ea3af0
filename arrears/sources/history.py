"""The report history: folders of months that never change, and lists of those that count.

A write puts its months under ``data/run=<id>``, one Parquet partition per
balance date, and then a new list of all folders that make up the history under
``versions/<number>``. Spark marks a list as whole when it is; a reader takes
the newest whole list. So a write that fails, wherever it stops, leaves the
history as it was, and readers see all of a write or nothing of it. Writes to
one history must not overlap. Folders of the list before the newest stay for
those who still read them.

A plain folder of partitions by balance date is read as a history too; its
partitions become part of the first list.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from arrears.schemas import BALANCE_DATE, REPORT, REPORT_COLUMNS
from arrears.sources.report_csv import file_columns
from arrears.sources.scratch import discard

_LISTED = "day string, folder string"
_NUMBER = re.compile(r"versions/(\d+)(?:/_SUCCESS)?$")


def read_history(spark: SparkSession, path: str, with_files: bool = False) -> DataFrame:
    """The rows of the newest whole list; ``with_files`` adds when and where each was saved."""
    version = _newest(spark, path)
    columns = [*REPORT_COLUMNS, *(file_columns() if with_files else [])]
    if version is None:
        return spark.read.schema(REPORT).parquet(path).select(*columns)
    folders = sorted({folder for _, folder in _listed(spark, path, version)})
    # Older plain partitions lie beside ``data``.
    parts = [
        spark.read.schema(REPORT).option("basePath", base).parquet(*[f"{path}/{f}" for f in own]).select(*columns)
        for base, own in (
            (f"{path}/data", [f for f in folders if f.startswith("data/")]),
            (path, [f for f in folders if not f.startswith("data/")]),
        )
        if own
    ]
    if not parts:
        empty = spark.createDataFrame([], REPORT)
        return empty.selectExpr("*", "CAST(NULL AS timestamp) AS saved_at", "CAST(NULL AS string) AS saved_in") if with_files else empty
    return reduce(DataFrame.unionByName, parts)


def append_history(report: DataFrame, path: str) -> None:
    """Add rows. Running a month twice leaves two rows for its date."""
    prepare_append(report, path)()


def upsert_history(report: DataFrame, path: str) -> None:
    """Replace the dates of ``report`` and keep all others; safe to repeat."""
    prepare_upsert(report, path)()


def rebuild_history(report: DataFrame, path: str) -> None:
    """Replace the whole history. ``report`` may read from it."""
    _prepare(report, path, lambda old, new: new)()


def prepare_append(report: DataFrame, path: str) -> Callable[[], None]:
    """``append_history`` up to the last step, which the result makes."""
    return _prepare(report, path, lambda old, new: old + new)


def prepare_upsert(report: DataFrame, path: str) -> Callable[[], None]:
    """``upsert_history`` up to the last step, which the result makes."""

    def replaced(old: list[tuple[str, str]], new: list[tuple[str, str]]) -> list[tuple[str, str]]:
        days = {day for day, _ in new}
        return [entry for entry in old if entry[0] not in days] + new

    return _prepare(report, path, replaced)


def _prepare(report: DataFrame, path: str, merge: Callable[[list, list], list]) -> Callable[[], None]:
    spark, run = report.sparkSession, f"data/run={uuid4().hex}"
    report.select(*REPORT_COLUMNS).write.partitionBy(BALANCE_DATE).parquet(f"{path}/{run}")

    def commit() -> None:
        version = _newest(spark, path)
        old = _partitions(spark, path, "") if version is None else _listed(spark, path, version)
        _write_list(spark, path, merge(old, _partitions(spark, path, f"{run}/")))
        _clean(spark, path)

    return commit


def _write_list(spark: SparkSession, path: str, entries: list[tuple[str, str]]) -> None:
    # A list that a failed write left unfinished keeps its number.
    taken = [int(_NUMBER.search(found)[1]) for found in _glob(spark, f"{path}/versions/*")]
    rows = spark.createDataFrame(entries, _LISTED).coalesce(1)
    rows.write.json(f"{path}/versions/{max(taken, default=0) + 1:08d}")


def _newest(spark: SparkSession, path: str) -> str | None:
    whole = [_NUMBER.search(found)[1] for found in _glob(spark, f"{path}/versions/*/_SUCCESS")]
    return max(whole, key=int, default=None)


def _listed(spark: SparkSession, path: str, version: str) -> list[tuple[str, str]]:
    """Days and folders of a list: about a row per month, whatever the loans."""
    rows = spark.read.schema(_LISTED).json(f"{path}/versions/{version}").collect()
    return [(row["day"], row["folder"]) for row in rows]


def _partitions(spark: SparkSession, path: str, under: str) -> list[tuple[str, str]]:
    names = [found.rsplit("/", 1)[1] for found in _glob(spark, f"{path}/{under}{BALANCE_DATE}=*")]
    return [(name.partition("=")[2], f"{under}{name}") for name in sorted(names)]


def _clean(spark: SparkSession, path: str) -> None:
    """Delete what neither of the two newest whole lists names."""
    whole = sorted(int(_NUMBER.search(found)[1]) for found in _glob(spark, f"{path}/versions/*/_SUCCESS"))
    kept = {folder for n in whole[-2:] for _, folder in _listed(spark, path, f"{n:08d}")}
    for found in _glob(spark, f"{path}/versions/*"):
        if int(_NUMBER.search(found)[1]) < whole[-2:][0]:
            discard(spark, found)
    for folder in [f for _, f in _partitions(spark, path, "")] + _runs(spark, path):
        if not any(name == folder or name.startswith(f"{folder}/") for name in kept):
            discard(spark, f"{path}/{folder}")


def _runs(spark: SparkSession, path: str) -> list[str]:
    return [f"data/{found.rsplit('/', 1)[1]}" for found in _glob(spark, f"{path}/data/run=*")]


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that exist, on whatever file system they are."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return [status.getPath().toString() for status in found] if found is not None else []
