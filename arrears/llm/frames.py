"""Columns and reads that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that separate words.
GAPS = " \t\n\x0b\x0c\r"

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """With the id it names a row's content, so that a repeated id with another
    text is told apart, and rows that repeat both get the same result."""
    return F.xxhash64(F.col(column))


def words(text: Column) -> Column:
    """The runs of characters other than ``GAPS``.

    Splitting at one literal character avoids a regular expression per word.
    """
    spaced = F.translate(text, GAPS[1:], " " * (len(GAPS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def unit_hash(*columns: Column) -> Column:
    """A uniform number in [0, 1) that depends on the values only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def crc_bucket(column: str, modulus: int) -> Column:
    """The id's CRC-32, taken of its decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % modulus


def pieces(values: list, size: int) -> Iterator[list]:
    for at in range(0, len(values), size):
        yield values[at : at + size]
