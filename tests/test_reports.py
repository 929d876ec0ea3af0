"""Segments and reports on hand-made books."""

from datetime import date, datetime

import pytest
from conftest import MARCH, bucket, installment, loan, make_book, one_row
from pyspark.errors import PySparkException

from arrears.config import ReportConfig
from arrears.plans.reports import count_report, full_report, preview, segment_report, segment_sizes
from arrears.schemas import COUNT_REPORT, COUNT_REPORT_COLUMNS, REPORT, REPORT_COLUMNS

CONFIG = ReportConfig(run_date=date(2024, 4, 5))
DUE = date(2024, 2, 10)


def segment(book, name, **config):
    row = one_row(segment_report(book, ReportConfig(run_date=date(2024, 4, 5), **config), name))
    return row["observed"], row["defaulted"], row["total_amount"], row["outstanding_amount"]


def test_two_bucket_rows_count_once_and_add_up(spark):
    book = make_book(
        spark,
        [installment("1", 1, DUE, delinquent=1)],
        [loan("1"), loan("1")],
        [bucket("1", MARCH), bucket("1", MARCH, amounts=(1, None, None, None), outstanding=None)],
        [1, 1],
    )
    assert segment(book, "first_payment") == (1, 1, 1112.0, 500.0)
    assert segment(book, "fraud_90plus", fraud_mode="only")[:3] == (1, 0, 1112.0)


def test_days_past_due_threshold_is_strict(spark):
    days = {"1": None, "2": 90, "3": 91}
    book = make_book(
        spark,
        [installment(n, 1, DUE) for n in days],
        [loan(n) for n in days],
        [bucket(n, MARCH, dpd=dpd) for n, dpd in days.items()],
    )
    assert segment(book, "overall_90plus") == (3, 1, 3333.0, 500.0)
    assert segment(book, "overall_90plus", dpd_threshold=89)[1] == 2


def test_only_the_rows_over_the_threshold_are_owed(spark):
    book = make_book(
        spark,
        [installment("1", 1, DUE)],
        [loan("1")],
        [bucket("1", MARCH, outstanding=5, dpd=91), bucket("1", MARCH, outstanding=7, dpd=3)],
    )
    assert segment(book, "overall_90plus")[1::2] == (1, 5.0)


def test_second_plus_observes_first_payment_defaulters(spark):
    book = make_book(
        spark,
        [
            installment("f", 1, DUE, delinquent=1),
            installment("f", 2, DUE, delinquent=1),
            installment("s", 1, DUE),
            installment("s", 2, DUE, delinquent=1),
            installment("o", 2, DUE),
        ],
        [loan(n) for n in "fso"],
        [bucket(n, MARCH) for n in "fso"],
    )
    assert segment(book, "second_plus")[:2] == (3, 1)
    assert segment(book, "first_payment")[:2] == (2, 1)


def test_other_month_ends_and_closed_loans_are_left_out(spark):
    numbers = ["in", "old", "undisbursed", "closed", "no_master", "no_installment"]
    book = make_book(
        spark,
        [installment(n, 1, DUE) for n in numbers[:-1]],
        [
            loan("in", status=None),
            loan("old"),
            loan("undisbursed", flag=0),
            loan("closed", status="Settled"),
            loan("no_installment"),
        ],
        [bucket(n, date(2024, 2, 29) if n == "old" else MARCH) for n in numbers] + [bucket(None, MARCH)],
    )
    assert segment(book, "first_payment")[0] == 1


def test_cohort(spark):
    loans = [
        loan("1"),
        loan("2", disbursed=datetime(2023, 5, 1)),
        loan("3", disbursed=None),
        # two rows: one makes it active, the other puts it in the cohort
        loan("4", status="Completed"),
        loan("4", disbursed=datetime(2023, 5, 1)),
    ]
    book = make_book(
        spark,
        [installment(n, 1, DUE) for n in "1234"],
        loans,
        [bucket(n, MARCH, dpd=100) for n in "1234"],
    )
    assert segment(book, "cohort_90plus")[:2] == (2, 2)
    assert segment(book, "cohort_90plus", cohort_year=2023)[:2] == (2, 2)


def fraud_book(spark, fraud, number="12"):
    return make_book(
        spark,
        [installment(n, 1, DUE) for n in (number, "13")],
        [loan(n) for n in (number, "13")],
        [bucket(n, MARCH, dpd=91) for n in (number, "13")],
        fraud,
    )


def test_fraud_modes_split_the_portfolio(spark):
    book = fraud_book(spark, [12, 99])
    assert segment(book, "fraud_90plus")[:2] == (1, 1)
    assert segment(book, "fraud_90plus", fraud_mode="only")[:2] == (1, 1)
    assert segment(book, "overall_90plus")[:2] == (2, 2)


def test_empty_fraud_list_excludes_nothing(spark):
    book = fraud_book(spark, [])
    assert segment(book, "fraud_90plus")[0] == 2
    assert segment(book, "fraud_90plus", fraud_mode="only") == (0, 0, None, None)


def test_loan_numbers_are_compared_as_integers(spark):
    assert segment(fraud_book(spark, [12], number="0012"), "fraud_90plus", fraud_mode="only")[0] == 1


def test_bad_loan_number_fails_unless_told_otherwise(spark):
    book = fraud_book(spark, [12], number="12x")
    with pytest.raises(PySparkException, match="loan number is not an integer: 12x"):
        segment(book, "fraud_90plus")
    assert segment(book, "fraud_90plus", strict_loan_numbers=False)[0] == 2
    assert segment(book, "overall_90plus")[0] == 2


def test_bad_loan_number_outside_the_segment_is_no_error(spark):
    book = make_book(
        spark,
        [installment("x", 2, DUE), *(installment(n, 1, DUE) for n in "yz1")],
        [loan("x"), loan("y", status="Settled"), loan("z"), loan("1")],
        [bucket(n, MARCH) for n in "xy1"],
    )
    assert one_row(full_report(book, CONFIG))["totalobservationfraud90plusportfolio"] == 1


def test_empty_book_gives_zero_counts_and_null_amounts(spark):
    row = one_row(full_report(make_book(spark), CONFIG))
    assert row.pop("Balance_Date") == MARCH
    for start in range(0, 30, 6):
        assert list(row.values())[start : start + 6] == [0, 0, None, None, None, None]


def test_every_balance_date_has_a_row(spark):
    book = fraud_book(spark, [])
    config = ReportConfig(run_date=date(2024, 4, 5), months_back=(0, 1, 2))
    rows = {r.Balance_Date: r.totalobservedportfolio for r in full_report(book, config).collect()}
    assert rows == {MARCH: 2, date(2024, 2, 29): 0, date(2024, 1, 31): 0}


def test_backfill_moves_due_dates_but_not_status(spark):
    february = date(2024, 2, 29)
    book = make_book(
        spark,
        [
            installment("1", 1, date(2024, 2, 1), delinquent=1),
            installment("1", 2, date(2024, 3, 1), delinquent=1),
            installment("2", 1, date(2024, 3, 1), delinquent=1),
            # defaults on the second payment before its first falls due
            installment("3", 2, date(2024, 2, 1), delinquent=1),
            installment("3", 1, date(2024, 3, 1), delinquent=1),
        ],
        [loan(n) for n in "123"],
        [bucket(n, day) for n in "123" for day in (february, MARCH)],
    )
    rows = {
        r.Balance_Date: r
        for r in full_report(book, ReportConfig(run_date=date(2024, 4, 5), months_back=(0, 1))).collect()
    }
    assert rows[february].firstpaymentoverallobservation == 1
    assert rows[february].secondplusoverallobservation == 1
    assert rows[february].cntsecondinstallmentdefault == 1
    assert rows[MARCH].firstpaymentdefaultcnt == 3
    assert rows[MARCH].secondplusoverallobservation == 2
    assert rows[MARCH].cntsecondinstallmentdefault == 0


# The columns of saved reports, in their order.
FULL_NAMES = """
Balance_Date firstpaymentdefaultcnt firstpaymentoverallobservation firstpaymentdefault
firstpaymentTotal_Outstanding_Amount firstpaymenttotalamount firstpaymentdefaultv cntsecondinstallmentdefault
secondplusoverallobservation secondpluspaymentdefault cntsecondTotal_Outstanding_Amount secondplustotalamount
secondpluspaymentdefaultv cnt90plusoveralldefault totalobservedportfolio overall90plusdefaultrate
cnt90plusoverallTotal_Outstanding_Amount totalobservedportfoliototalamount overall90plusdefaultratev
cnt90plusfrauddefault totalobservationfraud90plusportfolio fraud90plusdefaultrate
cnt90plusfrauddefaultTotal_Outstanding_Amount totalobservationfraud90plusportfoliototalamount
fraud90plusdefaultratev total90plustdefault2022portfolio totalobservation2022portfolio
total90plus2022defaultrate total90plustdefault2022portfolioTotal_Outstanding_Amount
totalobservation2022portfoliototalamount total90plus2022defaultratev
""".split()
COUNT_NAMES = """
Balance_Date firstpaymentdefaultcnt firstpaymentoverallobservation firstpaymentdefault
cntsecondinstallmentdefault secondplusoverallobservation secondpluspaymentdefault cnt90plusoveralldefault
totalobservedportfolio overall90plusdefaultrate cnt90plusfrauddefault totalobservationfraud90plusportfolio
fraud90plusdefaultrate total90plustdefault2022portfolio totalobservation2022portfolio
total90plus2022defaultrate
""".split()


def test_report_layout(spark):
    book = make_book(spark)
    full, counts = full_report(book, CONFIG), count_report(book, CONFIG)
    assert full.columns == REPORT_COLUMNS == FULL_NAMES and len(FULL_NAMES) == 31
    assert counts.columns == COUNT_REPORT_COLUMNS == COUNT_NAMES and len(COUNT_NAMES) == 16
    assert [(f.name, f.dataType) for f in full.schema] == [(f.name, f.dataType) for f in REPORT]
    assert [(f.name, f.dataType) for f in counts.schema] == [(f.name, f.dataType) for f in COUNT_REPORT]


def test_segment_sizes_count_rows_of_active_loans(spark):
    book = make_book(
        spark,
        [
            installment("1", 1, DUE, delinquent=1),
            installment("1", 1, DUE),
            installment("2", 1, DUE),
            installment("2", 2, DUE, delinquent=1),
            installment("3", 1, date(2024, 5, 1)),
        ],
        [loan("1"), loan("1"), loan("9"), loan("2", status="Settled")],
    )
    assert one_row(segment_sizes(book, CONFIG)) == {
        "Balance_Date": MARCH,
        "activeloans": 3,
        "installmentone": 2,
        "installmentonedefault": 1,
    }
    months = segment_sizes(book, ReportConfig(run_date=date(2024, 6, 5), months_back=(0, 1, 2, 4))).collect()
    assert [tuple(r)[1:] for r in sorted(months)] == [(3, 0, 0), (3, 2, 1), (3, 2, 1), (3, 3, 1)]


def test_preview_is_newest_first(spark):
    config = ReportConfig(run_date=date(2024, 4, 5), months_back=tuple(range(7)))
    days = [r.Balance_Date for r in preview(full_report(make_book(spark), config)).collect()]
    assert days == sorted(config.balance_dates, reverse=True)[:5]
