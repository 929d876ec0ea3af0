"""The registered queries as plain SQL over the test tables.

Written with one subquery per loan set and one aggregate per segment and date,
so that it shares no structure with the one-pass DataFrame plan it checks. The
part below the loan book is portable: tests also run it on Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from arrears.checks.mapped import COHORT_YEAR, MONTH_ENDS
from arrears.plans.reports import SEGMENT_MEASURES
from arrears.schemas import BALANCE_DATE, COUNT_REPORT_COLUMNS, REPORT_COLUMNS, SEGMENT_COLUMNS

AS_OF = MONTH_ENDS[-1]

_INSTALLMENTS = """
installments_raw AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS loanAccountNumber,
         l.l_linenumber AS installmentNumber,
         CAST(CAST(o.o_orderdate AS DATE) + to_months(l.l_linenumber) AS DATE) AS installmentDueDate,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS isDelinquent,
         CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 1 ELSE 0 END AS isCurrentDelinquent,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         nullif(CAST(l.l_tax AS DECIMAL(4,2)), 0) AS tax,
         l.l_linestatus AS line_status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
installments_priced AS (
  SELECT *,
         CAST(price AS DECIMAL(18,4)) AS Principal,
         CAST(price * discount AS DECIMAL(18,4)) AS Interest,
         CAST(price * tax AS DECIMAL(18,4)) AS Penalty
  FROM installments_raw
),
installments AS (
  SELECT *,
         CASE WHEN line_status = 'F' THEN Principal ELSE 0 END AS Principal_paid,
         CASE WHEN line_status = 'F' THEN Interest ELSE 0 END AS Interest_paid,
         CASE WHEN line_status = 'F' THEN Penalty ELSE 0 END AS Penalty_paid
  FROM installments_priced
)"""

_LOANS = """
loans AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS loanAccountNumber,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0 ELSE 1 END AS flagDisbursement,
         CASE WHEN o_orderstatus = 'O' THEN 'Current'
              WHEN o_orderstatus <> 'F' THEN NULL
              WHEN o_orderpriority = '1-URGENT' THEN 'Written Off'
              WHEN o_orderpriority = '2-HIGH' THEN 'Settled'
              ELSE 'Completed' END AS loanPaidStatus,
         o_orderdate AS disbursementDateTime
  FROM orders JOIN (VALUES (1), (2)) AS r(nth) ON nth = 1 OR o_orderkey % 5 = 0
)"""

_MONTH_ENDS = ", ".join(f"(DATE '{day}')" for day in MONTH_ENDS)

_BUCKETS = f"""
month_ends AS (SELECT * FROM (VALUES {_MONTH_ENDS}) AS v(bucketDate)),
buckets_once AS (
  SELECT i.loanAccountNumber, m.bucketDate,
         sum(i.Principal) AS Loan_Principal,
         sum(i.Interest) AS Loan_Interest,
         sum(i.Penalty) AS Overdue_Penalty,
         sum(CASE WHEN i.installmentNumber = 1 THEN 100 END) + 2 * month(m.bucketDate) AS Loan_Fee,
         sum(CASE WHEN i.line_status = 'O' THEN i.Principal + i.Interest END) + 3 * month(m.bucketDate) AS Total_Outstanding_Amount,
         max(CASE WHEN i.isCurrentDelinquent = 1 AND i.installmentDueDate <= m.bucketDate
                  THEN date_diff('day', i.installmentDueDate, m.bucketDate) END) AS Max_current_DPD
  FROM installments i JOIN month_ends m
    ON i.installmentDueDate <= CAST(m.bucketDate + to_months(12) AS DATE)
  GROUP BY i.loanAccountNumber, m.bucketDate
),
buckets AS (
  SELECT b.* FROM buckets_once b
  JOIN (VALUES (1), (2)) AS r(nth) ON nth = 1 OR CAST(loanAccountNumber AS BIGINT) % 7 = 0
)"""

_FRAUD = """
fraud AS (
  SELECT o_orderkey AS fraud_loan
  FROM orders JOIN (VALUES (1), (2)) AS r(nth) ON nth = 1 OR o_orderkey % 3 = 0
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
)"""

LOAN_BOOK = f"WITH {_INSTALLMENTS},{_LOANS},{_BUCKETS},{_FRAUD}"


def loan_set(name: str, as_of: date = AS_OF, cohort_year: int = COHORT_YEAR) -> str:
    """A subquery that lists the loan numbers of a set."""
    due = f"installmentDueDate <= DATE '{as_of}'"
    first_default = (
        f"SELECT loanAccountNumber FROM installments WHERE installmentNumber = 1 AND isDelinquent = 1 AND {due}"
    )
    sets = {
        "first": f"SELECT loanAccountNumber FROM installments WHERE installmentNumber = 1 AND {due}",
        "first_default": first_default,
        "later": f"SELECT loanAccountNumber FROM installments WHERE installmentNumber >= 2 AND {due}",
        "later_default": "SELECT loanAccountNumber FROM installments WHERE installmentNumber >= 2"
        f" AND isDelinquent = 1 AND {due} AND loanAccountNumber NOT IN ({first_default})",
        "active": "SELECT loanAccountNumber FROM loans WHERE flagDisbursement = 1"
        " AND coalesce(loanPaidStatus, 'NA') NOT IN ('Written Off', 'Completed', 'Settled')",
        "cohort": "SELECT loanAccountNumber FROM loans WHERE flagDisbursement = 1"
        f" AND year(disbursementDateTime) = {cohort_year}",
        "fraud": "SELECT fraud_loan FROM fraud",
    }
    return f"({sets[name]})"


def _segment_rules(name: str, as_of: date, fraud_mode: str, cohort_year: int) -> tuple[str, str]:
    """Who is observed and what makes a bucket row a defaulted one."""

    def member(set_name: str) -> str:
        return f"loanAccountNumber IN {loan_set(set_name, as_of, cohort_year)}"

    active = member("active")
    over_90 = "coalesce(Max_current_DPD, 0) > 90"
    negation = "NOT " if fraud_mode == "exclude" else ""
    listed = f"CAST(loanAccountNumber AS BIGINT) {negation}IN {loan_set('fraud')}"
    return {
        "first_payment": (f"{active} AND {member('first')}", member("first_default")),
        "second_plus": (f"{active} AND {member('later')}", member("later_default")),
        "overall_90plus": (f"{active} AND {member('first')}", over_90),
        "fraud_90plus": (f"{active} AND {member('first')} AND {listed}", over_90),
        "cohort_90plus": (f"{active} AND {member('first')} AND {member('cohort')}", over_90),
    }[name]


def segment_measures(
    name: str, as_of: date = AS_OF, fraud_mode: str = "exclude", cohort_year: int = COHORT_YEAR
) -> str:
    """One row: observed and defaulted loans, total and outstanding amounts."""
    observed, defaulted = _segment_rules(name, as_of, fraud_mode, cohort_year)
    return f"""
    SELECT count(DISTINCT loanAccountNumber) AS observed,
           count(DISTINCT CASE WHEN {defaulted} THEN loanAccountNumber END) AS defaulted,
           sum(coalesce(Loan_Principal, 0) + coalesce(Loan_Interest, 0)
               + coalesce(Overdue_Penalty, 0) + coalesce(Loan_Fee, 0)) AS total,
           sum(CASE WHEN {defaulted} THEN coalesce(Total_Outstanding_Amount, 0) ELSE 0 END) AS outstanding
    FROM buckets
    WHERE bucketDate = DATE '{as_of}' AND {observed}"""


def report(
    as_of: date = AS_OF, fraud_mode: str = "exclude", cohort_year: int = COHORT_YEAR, counts_only: bool = False
) -> str:
    """The report row of one balance date over the four loan book tables."""
    columns, tables = [f"DATE '{as_of}' AS {BALANCE_DATE}"], []
    for i, (name, names) in enumerate(SEGMENT_COLUMNS.items()):
        tables.append(f"({segment_measures(name, as_of, fraud_mode, cohort_year)}) s{i}")
        measures = _measures(f"s{i}.", names)
        columns.extend(measures[:3] if counts_only else measures)
    return f"SELECT {', '.join(columns)} FROM {' CROSS JOIN '.join(tables)}"


def _measures(prefix: str, names: Sequence[str]) -> list[str]:
    defaulted, observed = f"{prefix}defaulted", f"{prefix}observed"
    outstanding, total = f"CAST({prefix}outstanding AS DOUBLE)", f"CAST({prefix}total AS DOUBLE)"
    values = (
        defaulted,
        observed,
        f"CAST({defaulted} AS DOUBLE) / nullif({observed}, 0)",
        outstanding,
        total,
        f"{outstanding} / nullif({total}, 0)",
    )
    return [f"{value} AS {name}" for value, name in zip(values, names)]


def _segment_report(name: str, fraud_mode: str = "exclude") -> str:
    columns = ", ".join(_measures("s.", SEGMENT_MEASURES))
    measures = segment_measures(name, fraud_mode=fraud_mode)
    return f"{LOAN_BOOK} SELECT DATE '{AS_OF}' AS {BALANCE_DATE}, {columns} FROM ({measures}) s"


def backfill(fraud_mode: str = "exclude") -> str:
    return " UNION ALL ".join(report(day, fraud_mode) for day in MONTH_ENDS)


def balances(kind: str, as_of: date = AS_OF) -> str:
    """Installment balances per loan over the installments table."""
    number = "installmentNumber = 1" if kind.startswith("first") else "installmentNumber >= 2"
    rules = [number, f"installmentDueDate <= DATE '{as_of}'"]
    if kind.endswith("delinquent"):
        rules.append("isDelinquent = 1")
        if kind.startswith("second"):
            rules.append(f"loanAccountNumber NOT IN {loan_set('first_default', as_of)}")
    if "current" in kind:
        rules.append("isCurrentDelinquent = 1")
    owed = (
        "sum(coalesce(Principal, 0)) + sum(coalesce(Interest, 0))"
        " + sum(coalesce(CAST(round(Penalty, 0) AS BIGINT), 0))"
    )
    paid = "sum(coalesce(Principal_paid, 0)) + sum(coalesce(Interest_paid, 0)) + sum(coalesce(Penalty_paid, 0))"
    return f"""
    SELECT loanAccountNumber,
           CAST({owed} AS DOUBLE) AS totalamount,
           CAST(({owed}) - ({paid}) AS DOUBLE) AS outstandingamount
    FROM installments WHERE {' AND '.join(rules)}
    GROUP BY loanAccountNumber"""


def _sizes(as_of: date = AS_OF) -> str:
    return f"""
    SELECT DATE '{as_of}' AS {BALANCE_DATE},
           (SELECT count(loanAccountNumber) FROM {loan_set('active')} a) AS activeloans,
           (SELECT count(DISTINCT loanAccountNumber) FROM {loan_set('first', as_of)} f) AS installmentone,
           (SELECT count(DISTINCT loanAccountNumber) FROM {loan_set('first_default', as_of)} d) AS installmentonedefault"""


# The newest fixed date, and the last day of the month before the one that the database is in.
_LATEST = f"DATE '{AS_OF}'"
_TODAY = "CAST(date_trunc('month', current_date) - INTERVAL 1 DAY AS DATE)"

_BALANCE_DATES = """
SELECT run_date, months_back,
       CAST(date_trunc('month', run_date - to_months(months_back)) - INTERVAL 1 DAY AS DATE) AS Balance_Date
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders) r
CROSS JOIN (VALUES (0), (1), (2), (3)) AS k(months_back)"""


def oracle_sql() -> dict[str, str]:
    months = f"{LOAN_BOOK} {backfill()}"
    newest_first = f"{LOAN_BOOK} SELECT {', '.join(REPORT_COLUMNS)} FROM ({backfill()}) b ORDER BY {BALANCE_DATE} DESC"
    latest = f"{LOAN_BOOK} {report()}"
    return {
        "balance_dates": _BALANCE_DATES,
        "inst_first": f"{LOAN_BOOK} {balances('first')}",
        "inst_first_delinquent": f"{LOAN_BOOK} {balances('first_delinquent')}",
        "inst_first_current_delinquent": f"{LOAN_BOOK} {balances('first_current_delinquent')}",
        "inst_second_plus": f"{LOAN_BOOK} {balances('second_plus')}",
        "inst_second_plus_delinquent": f"{LOAN_BOOK} {balances('second_plus_delinquent')}",
        "inst_second_plus_current_delinquent": f"{LOAN_BOOK} {balances('second_plus_current_delinquent')}",
        "active_loans": f"{LOAN_BOOK} SELECT * FROM {loan_set('active')} a",
        "cohort_loans": f"{LOAN_BOOK} SELECT * FROM {loan_set('cohort')} c",
        "fraud_accounts": f"{LOAN_BOOK} SELECT DISTINCT fraud_loan FROM fraud",
        "kri_first_payment": _segment_report("first_payment"),
        "kri_second_plus": _segment_report("second_plus"),
        "kri_90plus_overall": _segment_report("overall_90plus"),
        "kri_90plus_cohort": _segment_report("cohort_90plus"),
        "kri_90plus_excl_fraud": _segment_report("fraud_90plus"),
        "kri_90plus_only_fraud": _segment_report("fraud_90plus", "only"),
        "kri_report_counts": f"{LOAN_BOOK} {report(fraud_mode='only', counts_only=True)}",
        "kri_report_full": latest,
        "kri_report_full_only_fraud": f"{LOAN_BOOK} {report(fraud_mode='only')}",
        "kri_report_from_files": latest,
        "kri_backfill": months,
        "kri_backfill_only_fraud": f"{LOAN_BOOK} {backfill('only')}",
        "kri_history_append": months,
        "kri_history_rebuild": months,
        "kri_history_upsert": months,
        "kri_monthly_run": latest,
        "kri_csv_roundtrip": months,
        "kri_csv_counts": f"{LOAN_BOOK} SELECT {', '.join(COUNT_REPORT_COLUMNS[1:])}"
        f" FROM ({report(counts_only=True)}) c",
        "kri_monthly_summary": newest_first,
        "segment_sizes": f"{LOAN_BOOK} {_sizes()}",
        "segment_sizes_today": f"{LOAN_BOOK} {_sizes().replace(_LATEST, _TODAY)}",
        "segment_sizes_by_month": f"{LOAN_BOOK} {' UNION ALL '.join(map(_sizes, MONTH_ENDS))}",
        "report_preview": f"{newest_first} LIMIT 3",
    }
