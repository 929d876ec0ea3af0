"""Loaders of the four source tables.

Every loader checks that the columns exist and casts them once, so that later
steps can compare dates and sum decimals without further thought. The casts
vanish from the plan where the stored type already fits, which keeps filters
and column pruning at the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from arrears import schemas
from arrears.schemas import LOAN

# What amounts of other types become: 18 digits before the point and 16 after
# it, which leaves room for adding up four of them.
AMOUNT = DecimalType(34, 16)
FRAUD_LOAN = "fraud_loan"
TEXT_FORMATS = ("csv", "json")
NULL_KEY_ACTIONS = ("error", "drop")


@dataclass(frozen=True)
class LoanBook:
    """The four inputs of every report."""

    installments: DataFrame
    loans: DataFrame
    buckets: DataFrame
    fraud: DataFrame


def load_installments(
    spark: SparkSession, path: str, format: str = "parquet", null_keys: str = "error", **options: str
) -> DataFrame:
    return as_installments(_read(spark, path, format, schemas.INSTALLMENTS, options), null_keys)


def load_loans(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    return as_loans(_read(spark, path, format, schemas.LOANS, options))


def load_buckets(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    return as_buckets(_read(spark, path, format, schemas.BUCKETS, options))


def load_fraud(
    spark: SparkSession,
    path: str,
    fraud_key: str = LOAN,
    format: str = "parquet",
    null_keys: str = "error",
    **options: str,
) -> DataFrame:
    schema = StructType([StructField(fraud_key, LongType())])
    if format in TEXT_FORMATS:
        # The list may carry more columns in any order: take them by header.
        frame = spark.read.format(format).options(**{"header": "true", **options}).load(path)
    else:
        frame = _read(spark, path, format, schema, options)
    return as_fraud(frame, fraud_key, null_keys)


def as_installments(frame: DataFrame, null_keys: str = "error") -> DataFrame:
    """Conform any frame to the installment schema.

    A null loan number among the defaulted first installments would empty
    every "not a first-payment defaulter" test, so it is rejected (or dropped
    on request) here.
    """
    frame = _conform(frame, schemas.INSTALLMENTS)
    return _without_null(frame, LOAN, null_keys)


def as_loans(frame: DataFrame) -> DataFrame:
    return _conform(frame, schemas.LOANS)


def as_buckets(frame: DataFrame) -> DataFrame:
    return _conform(frame, schemas.BUCKETS)


def as_fraud(frame: DataFrame, fraud_key: str = LOAN, null_keys: str = "error") -> DataFrame:
    """The fraud list with all its columns and its key as ``fraud_loan``."""
    _require(frame, [fraud_key])
    keyed = frame.withColumn(FRAUD_LOAN, F.col(fraud_key).cast("bigint"))
    return _without_null(keyed, FRAUD_LOAN, null_keys)


def _read(
    spark: SparkSession, path: str, format: str, schema: StructType, options: dict[str, str]
) -> DataFrame:
    if format == "table":
        return spark.table(path)
    reader = spark.read.format(format)
    if format in TEXT_FORMATS:
        # Typed on read instead of inferred; a wrong header or value fails.
        reader = reader.schema(schema).options(header="true", enforceSchema="false", mode="FAILFAST")
    return reader.options(**options).load(path)


def _require(frame: DataFrame, names: list[str]) -> None:
    present = {name.lower() for name in frame.columns}
    missing = [name for name in names if name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns {missing}, found {frame.columns}")


def _conform(frame: DataFrame, schema: StructType) -> DataFrame:
    _require(frame, schema.fieldNames())
    stored = {field.name.lower(): field.dataType for field in frame.schema}

    def typed(field: StructField) -> Column | str:
        kind = stored[field.name.lower()]
        # Decimals stay as precise and as large as they are stored.
        both_decimal = isinstance(field.dataType, DecimalType) and isinstance(kind, DecimalType)
        if kind == field.dataType or both_decimal:
            return field.name
        # A day of a timestamp cannot fail, and a plain cast of it lets filters reach the scan.
        if isinstance(field.dataType, (DateType, TimestampType)) and not isinstance(kind, StringType):
            return F.col(field.name).cast(field.dataType)
        return _checked(field.name, kind, field.dataType)

    return frame.select(*[typed(field) for field in schema]).toDF(*schema.fieldNames())


def _checked(name: str, kind: DataType, target: DataType) -> Column:
    """The column cast to ``target``; a value that the cast would lose is an error.

    It raises with ANSI on or off, where a plain cast may give null, which
    would later count as 0. Amounts become ``AMOUNT``: a float keeps all that
    its text form has, but for less than 1e-16.
    """
    if isinstance(target, DecimalType):
        target = AMOUNT
    value = F.col(name)
    cast = value.try_cast(target)
    lost = cast.isNull()
    if isinstance(target, DecimalType) and isinstance(kind, (FloatType, DoubleType)):
        near = F.abs(value.cast("double")) * 1e-15 + 1e-16
        lost = lost | F.isnan(value) | (F.abs(cast.cast("double") - value.cast("double")) > near)
    message = F.concat(F.lit(f"{name} is no {target.simpleString()}: "), value.cast("string"))
    error = F.raise_error(message).cast(target)
    return F.when(value.isNotNull() & lost, error).otherwise(cast).alias(name)


def _without_null(frame: DataFrame, key: str, action: str) -> DataFrame:
    if action not in NULL_KEY_ACTIONS:
        raise ValueError(f"null_keys must be one of {NULL_KEY_ACTIONS}, got {action!r}")
    if action == "drop":
        return frame.filter(F.col(key).isNotNull())
    checked = F.coalesce(F.col(key), F.raise_error(F.lit(f"null {key}")).cast(frame.schema[key].dataType))
    return frame.withColumn(key, checked)
