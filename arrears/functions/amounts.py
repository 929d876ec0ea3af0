"""Amount arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0))


def whole_units(amount: Column) -> Column:
    """Round half away from zero to a whole number; null counts as 0.

    What a long does not hold is an error with ANSI on or off, where a plain
    cast of a large decimal would wrap round.
    """
    rounded = F.round(amount, 0)
    whole = rounded.try_cast("bigint")
    message = F.concat(F.lit("amount is no bigint: "), amount.cast("string"))
    lost = F.raise_error(message).cast("bigint")
    return or_zero(F.when(rounded.isNotNull() & whole.isNull(), lost).otherwise(whole))

