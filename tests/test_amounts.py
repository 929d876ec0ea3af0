from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from arrears.functions.amounts import or_zero, whole_units

HALVES = {"2.5": 3, "2.4": 2, "-2.5": -3, "-2.4": -2, "0.5": 1, "3.5": 4, "2.4999": 2}


@pytest.mark.parametrize("kind", ["decimal(18,4)", "double"])
def test_whole_units_round_half_away_from_zero(spark, kind):
    frame = spark.createDataFrame([(text,) for text in HALVES], "text string")
    rounded = frame.select("text", whole_units(F.col("text").cast(kind)).alias("whole"))
    assert {row.text: row.whole for row in rounded.collect()} == HALVES
    assert rounded.schema["whole"].dataType.simpleString() == "bigint"


def test_unknown_amounts_count_as_zero(spark):
    frame = spark.createDataFrame([(None,), (Decimal("1.5"),)], "amount decimal(18,4)")
    found = frame.select(or_zero(F.col("amount")), whole_units(F.col("amount")))
    assert [tuple(row) for row in found.collect()] == [(0, 0), (Decimal("1.5"), 2)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_amounts_beyond_a_bigint_fail(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        frame = spark.createDataFrame([(Decimal(10**19),)], "amount decimal(24,4)")
        with pytest.raises(PySparkException, match="no bigint: 10000000000000000000"):
            frame.select(whole_units(F.col("amount"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
