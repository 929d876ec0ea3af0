"""Spark sessions."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What every report run needs. Dates are taken in UTC. Decimal overflow and
# bad values must fail (ANSI). Shuffle partitions are merged to the advisory
# size at run time. Joins stay sort-merge joins, which spill: hashing a side
# by its compressed shuffle size ran out of memory on a 60-month backfill.
# A backfill joins by loan and date; rows that are dealt out by loan alone, as
# those of bucketed tables are, lie right for that and need no shuffle.
REPORT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

# On top of that for inputs of tens of terabytes. An estimate: none of it was
# run at that size. Reports read a third of the
# columns or less, so scan tasks can cover a gigabyte of file. The installment
# grouping shuffles about a quarter of the installment files' size: at 60 TB
# that is 15 TB, or a gigabyte for each of 16000 partitions, which spill if
# they must. Fewer, larger shuffle blocks beat more partitions here.
LARGE_CONF = {
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2g",
}


UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def require_utc(spark: SparkSession) -> None:
    """Refuse a session in which days and years would be those of another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"reports take days in UTC, set spark.sql.session.timeZone to UTC instead of {zone!r}")


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("arrears")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in REPORT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
