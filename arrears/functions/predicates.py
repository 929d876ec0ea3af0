"""Row predicates on the source tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def due_by(balance_date: date | Column) -> Column:
    return F.col("installmentDueDate") <= F.lit(balance_date)


def first_installment() -> Column:
    return F.col("installmentNumber") == 1


def later_installment() -> Column:
    return F.col("installmentNumber") >= 2


def ever_delinquent() -> Column:
    return F.col("isDelinquent") == 1


def currently_delinquent() -> Column:
    return F.col("isCurrentDelinquent") == 1


def disbursed() -> Column:
    return F.col("flagDisbursement") == 1


def still_open(closed_statuses: Sequence[str]) -> Column:
    """A loan without a status counts as open."""
    return ~F.coalesce(F.col("loanPaidStatus"), F.lit("NA")).isin(*closed_statuses)


def disbursed_in(year: int) -> Column:
    return F.year("disbursementDateTime") == year


def past_due_over(days: int) -> Column:
    """Strictly more than ``days`` past due; unknown counts as 0 days."""
    return F.coalesce(F.col("Max_current_DPD"), F.lit(0)) > days
