"""Loan sets with their installment balances, one row per loan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.config import CLOSED_STATUSES
from arrears.functions import predicates as p
from arrears.functions.amounts import or_zero, whole_units
from arrears.schemas import LOAN
from arrears.session import require_utc
from arrears.sources.tables import FRAUD_LOAN

# kind: (which installments, what must hold on them)
BALANCE_KINDS = {
    "first": (p.first_installment, ()),
    "first_delinquent": (p.first_installment, (p.ever_delinquent,)),
    "first_current_delinquent": (p.first_installment, (p.ever_delinquent, p.currently_delinquent)),
    "second_plus": (p.later_installment, ()),
    "second_plus_delinquent": (p.later_installment, (p.ever_delinquent,)),
    "second_plus_current_delinquent": (p.later_installment, (p.ever_delinquent, p.currently_delinquent)),
}


def installment_balances(installments: DataFrame, kind: str, balance_date: date) -> DataFrame:
    """Total and outstanding amounts of the installments due by ``balance_date``.

    The delinquent second-plus kinds leave out loans that defaulted on their
    first installment. Those installments are read along and marked in the
    same grouping, which saves a second scan and an anti join.
    """
    require_utc(installments.sparkSession)
    which, conditions = BALANCE_KINDS[kind]
    counted = which()
    for condition in conditions:
        counted = counted & condition()
    due = installments.filter(p.due_by(balance_date))

    if which is p.later_installment and conditions:
        first_default = p.first_installment() & p.ever_delinquent()
        marked = due.filter(counted | first_default).withColumn("counted", p.later_installment())
        per_loan = (
            marked.groupBy(LOAN)
            .agg(*_sums(F.col("counted")), F.bool_and("counted").alias("only_counted"))
            .filter("only_counted")
        )
    else:
        per_loan = due.filter(counted).groupBy(LOAN).agg(*_sums(F.lit(True)))

    total = F.col("principal") + F.col("interest") + F.col("penalty")
    paid = F.col("principal_paid") + F.col("interest_paid") + F.col("penalty_paid")
    return per_loan.select(LOAN, total.alias("totalamount"), (total - paid).alias("outstandingamount"))


def _sums(counted):
    amounts = {
        "principal": or_zero(F.col("Principal")),
        "interest": or_zero(F.col("Interest")),
        "penalty": whole_units(F.col("Penalty")),
        "principal_paid": or_zero(F.col("Principal_paid")),
        "interest_paid": or_zero(F.col("Interest_paid")),
        "penalty_paid": or_zero(F.col("Penalty_paid")),
    }
    return [F.sum(F.when(counted, amount)).alias(name) for name, amount in amounts.items()]


def active_loans(loans: DataFrame, closed_statuses: Sequence[str] = CLOSED_STATUSES) -> DataFrame:
    """Rows of disbursed loans that are not closed."""
    return loans.filter(p.disbursed() & p.still_open(closed_statuses)).select(LOAN)


def cohort_loans(loans: DataFrame, year: int) -> DataFrame:
    """Rows of loans disbursed in ``year``."""
    require_utc(loans.sparkSession)
    return loans.filter(p.disbursed() & p.disbursed_in(year)).select(LOAN)


def fraud_accounts(fraud: DataFrame) -> DataFrame:
    """The distinct loan numbers of the fraud list."""
    return fraud.select(FRAUD_LOAN).distinct()
