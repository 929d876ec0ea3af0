"""As-of dates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def balance_date(run_date: Column, months_back: Column | int = 0) -> Column:
    """Last day of the month before the run month, ``months_back`` months earlier."""
    offset = F.lit(months_back) if isinstance(months_back, int) else months_back
    return F.date_sub(F.trunc(F.add_months(run_date, -offset), "MM"), 1)


def balance_date_of(run_date: date, months_back: int = 0) -> date:
    """``balance_date`` of one known day, so that scans get a literal to prune with."""
    month_index = run_date.year * 12 + run_date.month - 1 - months_back
    return date(month_index // 12, month_index % 12 + 1, 1) - timedelta(days=1)
