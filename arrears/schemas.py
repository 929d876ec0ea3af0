"""Source schemas and the report layout."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

AMOUNT = DecimalType(18, 4)
LOAN = "loanAccountNumber"
BALANCE_DATE = "Balance_Date"


def _schema(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


INSTALLMENTS = _schema(
    (LOAN, StringType()),
    ("installmentNumber", IntegerType()),
    ("installmentDueDate", DateType()),
    ("isDelinquent", IntegerType()),
    ("isCurrentDelinquent", IntegerType()),
    ("Principal", AMOUNT),
    ("Interest", AMOUNT),
    ("Penalty", AMOUNT),
    ("Principal_paid", AMOUNT),
    ("Interest_paid", AMOUNT),
    ("Penalty_paid", AMOUNT),
)

LOANS = _schema(
    (LOAN, StringType()),
    ("flagDisbursement", IntegerType()),
    ("loanPaidStatus", StringType()),
    ("disbursementDateTime", TimestampType()),
)

BUCKETS = _schema(
    (LOAN, StringType()),
    ("bucketDate", DateType()),
    ("Loan_Principal", AMOUNT),
    ("Loan_Interest", AMOUNT),
    ("Overdue_Penalty", AMOUNT),
    ("Loan_Fee", AMOUNT),
    ("Total_Outstanding_Amount", AMOUNT),
    ("Max_current_DPD", IntegerType()),
)

# The report's column names. Each segment has a defaulted count,
# an observed count, their rate, an outstanding amount, a total amount and
# their rate. Segments and names stand in report order.
SEGMENT_COLUMNS = {
    "first_payment": (
        "firstpaymentdefaultcnt",
        "firstpaymentoverallobservation",
        "firstpaymentdefault",
        "firstpaymentTotal_Outstanding_Amount",
        "firstpaymenttotalamount",
        "firstpaymentdefaultv",
    ),
    "second_plus": (
        "cntsecondinstallmentdefault",
        "secondplusoverallobservation",
        "secondpluspaymentdefault",
        "cntsecondTotal_Outstanding_Amount",
        "secondplustotalamount",
        "secondpluspaymentdefaultv",
    ),
    "overall_90plus": (
        "cnt90plusoveralldefault",
        "totalobservedportfolio",
        "overall90plusdefaultrate",
        "cnt90plusoverallTotal_Outstanding_Amount",
        "totalobservedportfoliototalamount",
        "overall90plusdefaultratev",
    ),
    "fraud_90plus": (
        "cnt90plusfrauddefault",
        "totalobservationfraud90plusportfolio",
        "fraud90plusdefaultrate",
        "cnt90plusfrauddefaultTotal_Outstanding_Amount",
        "totalobservationfraud90plusportfoliototalamount",
        "fraud90plusdefaultratev",
    ),
    "cohort_90plus": (
        "total90plustdefault2022portfolio",
        "totalobservation2022portfolio",
        "total90plus2022defaultrate",
        "total90plustdefault2022portfolioTotal_Outstanding_Amount",
        "totalobservation2022portfoliototalamount",
        "total90plus2022defaultratev",
    ),
}

_KINDS = (LongType(), LongType(), DoubleType(), DoubleType(), DoubleType(), DoubleType())

REPORT = StructType(
    [StructField(BALANCE_DATE, DateType())]
    + [
        StructField(name, kind)
        for names in SEGMENT_COLUMNS.values()
        for name, kind in zip(names, _KINDS)
    ]
)
REPORT_COLUMNS = REPORT.fieldNames()

COUNT_REPORT = StructType(
    [StructField(BALANCE_DATE, DateType())]
    + [
        StructField(name, kind)
        for names in SEGMENT_COLUMNS.values()
        for name, kind in zip(names[:3], _KINDS)
    ]
)
COUNT_REPORT_COLUMNS = COUNT_REPORT.fieldNames()
