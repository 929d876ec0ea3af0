"""The test tables seen as a loan book.

An order is a loan, its line items are installments due one month apart, and
four month-end snapshots are summed up from them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.schemas import LOAN
from arrears.sources.tables import LoanBook, as_buckets, as_fraud, as_installments, as_loans

# Fixed values of the mapping.
MONTH_ENDS = (date(1998, 6, 30), date(1998, 7, 31), date(1998, 8, 31), date(1998, 9, 30))
RUN_DATE = date(1998, 10, 4)
COHORT_YEAR = 1997
# What a month's number is multiplied by and added to an amount of that month
# end, so that no two snapshots of a loan agree.
GROWTH = {"Loan_Fee": 2, "Total_Outstanding_Amount": 3}
FRAUD_KEY = "ACCOUNTNUMBER"

# The columns used of the test tables.
TEST_TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string",
    "customer": "c_custkey bigint, c_acctbal double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by its known schema, without a job to infer it."""
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def loan_book(spark: SparkSession, sf_dir: str) -> LoanBook:
    orders, lineitem, customer = (read_table(spark, sf_dir, name) for name in TEST_TABLES)
    installments = _installments(lineitem, orders)
    return LoanBook(
        installments=as_installments(installments),
        loans=as_loans(_loans(orders)),
        buckets=as_buckets(_buckets(installments)),
        fraud=as_fraud(_fraud(orders, customer), FRAUD_KEY),
    )


def _repeated(frame: DataFrame, key: str, every: int) -> DataFrame:
    """Rows whose key ``every`` divides stand twice."""
    times = F.sequence(F.lit(1), F.expr(f"if(cast({key} AS bigint) % {every} = 0, 2, 1)"))
    return frame.select("*", F.explode(times).alias("_nth")).drop("_nth")


def _loans(orders: DataFrame) -> DataFrame:
    return _repeated(orders, "o_orderkey", 5).selectExpr(
        f"cast(o_orderkey AS string) AS {LOAN}",
        "if(o_orderpriority = '4-NOT SPECIFIED', 0, 1) AS flagDisbursement",
        """CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Written Off'
                WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'Settled'
                WHEN o_orderstatus = 'F' THEN 'Completed'
                WHEN o_orderstatus = 'O' THEN 'Current' END AS loanPaidStatus""",
        "o_orderdate AS disbursementDateTime",
    )


def _installments(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    priced = lineitem.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag = 'R' AS returned",
        "l_linestatus = 'F' AS is_paid",
        "l_linestatus = 'O' AS is_open",
        "cast(l_extendedprice AS decimal(18,2)) AS price",
        "cast(l_discount AS decimal(4,2)) AS discount",
        "nullif(cast(l_tax AS decimal(4,2)), 0) AS tax",
    )
    return priced.join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr(
        f"cast(l_orderkey AS string) AS {LOAN}",
        "l_linenumber AS installmentNumber",
        "add_months(o_orderdate, l_linenumber) AS installmentDueDate",
        "if(returned, 1, 0) AS isDelinquent",
        "if(returned AND is_open, 1, 0) AS isCurrentDelinquent",
        "cast(price AS decimal(18,4)) AS Principal",
        "cast(price * discount AS decimal(18,4)) AS Interest",
        "cast(price * tax AS decimal(18,4)) AS Penalty",
        "if(is_paid, cast(price AS decimal(18,4)), 0) AS Principal_paid",
        "if(is_paid, price * discount, 0) AS Interest_paid",
        "if(is_paid, price * tax, 0) AS Penalty_paid",
        "is_open",
    )


def _buckets(installments: DataFrame) -> DataFrame:
    """Sums per loan and month end over the installments due within a year of it.

    An installment enters at one month end and stays in at all later ones. So
    the amounts are summed by loan and month of entry in one grouping by loan,
    added up along the months and only then turned into a row per month end.
    """
    months = range(len(MONTH_ENDS))
    limits = [f"add_months(DATE '{day}', 12)" for day in MONTH_ENDS]
    entry = " ".join(f"WHEN installmentDueDate <= {limits[m]} THEN {m}" for m in months)
    amounts = {
        "Loan_Principal": "Principal",
        "Loan_Interest": "Interest",
        "Overdue_Penalty": "Penalty",
        "Loan_Fee": "if(installmentNumber = 1, 100, null)",
        "Total_Outstanding_Amount": "if(is_open, Principal + Interest, null)",
    }
    entered = [f"sum({name}) FILTER (WHERE entry = {m}) AS {name}_{m}" for name in amounts for m in months]
    per_loan = (
        installments.selectExpr(
            LOAN,
            "if(isCurrentDelinquent = 1, installmentDueDate, null) AS late_due",
            f"CASE {entry} END AS entry",
            *[f"{amount} AS {name}" for name, amount in amounts.items()],
        )
        .filter("entry IS NOT NULL")
        .groupBy(LOAN)
        .agg(*map(F.expr, ["min(entry) AS first_entry", "min(late_due) AS late_since", *entered]))
    )

    def at(month: int) -> str:
        day = f"DATE '{MONTH_ENDS[month]}'"
        fields = [f"'bucketDate', {day}"]
        for name in amounts:
            parts = [f"{name}_{m}" for m in range(month + 1)]
            total = " + ".join(f"ifnull({part}, 0)" for part in parts)
            grown = f"{total} + {GROWTH[name] * MONTH_ENDS[month].month}BD" if name in GROWTH else total
            fields.append(f"'{name}', if(coalesce({', '.join(parts)}) IS NULL, null, {grown})")
        fields.append(f"'Max_current_DPD', if(late_since <= {day}, datediff({day}, late_since), null)")
        return f"if(first_entry <= {month}, named_struct({', '.join(fields)}), null)"

    rows = ", ".join(at(month) for month in months)
    return _repeated(per_loan.selectExpr(LOAN, f"inline(array_compact(array({rows})))"), LOAN, 7)


def _fraud(orders: DataFrame, customer: DataFrame) -> DataFrame:
    in_debt = customer.filter("c_acctbal < 0")
    listed = orders.join(in_debt, F.expr("o_custkey = c_custkey")).selectExpr(f"o_orderkey AS {FRAUD_KEY}")
    return _repeated(listed, FRAUD_KEY, 3)
