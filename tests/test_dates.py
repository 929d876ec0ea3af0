from datetime import date, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arrears.config import ReportConfig
from arrears.functions.dates import balance_date, balance_date_of

CASES = [
    (date(2024, 3, 31), [date(2024, 2, 29), date(2024, 1, 31), date(2023, 12, 31), date(2023, 11, 30)]),
    (date(2024, 3, 1), [date(2024, 2, 29), date(2024, 1, 31), date(2023, 12, 31), date(2023, 11, 30)]),
    (date(2023, 1, 15), [date(2022, 12, 31), date(2022, 11, 30), date(2022, 10, 31), date(2022, 9, 30)]),
]


@pytest.mark.parametrize("run_date, expected", CASES)
def test_balance_date_of_month_offsets(run_date, expected):
    assert [balance_date_of(run_date, k) for k in range(4)] == expected


@pytest.mark.parametrize("run_date, expected", CASES)
def test_column_form_agrees(spark, run_date, expected):
    frame = spark.range(4).select(balance_date(F.lit(run_date), F.col("id").cast("int")).alias("day"))
    assert sorted(row.day for row in frame.collect()) == sorted(expected)


def test_config_dates_are_distinct_and_sorted():
    config = ReportConfig(run_date=date(2024, 3, 31), months_back=(1, 0, 1))
    assert config.balance_dates == [date(2024, 1, 31), date(2024, 2, 29)]


def test_config_defaults_to_last_month():
    (day,) = ReportConfig().balance_dates
    assert day < date.today().replace(day=1)


def test_config_rejects_bad_values():
    with pytest.raises(ValueError, match="fraud_mode"):
        ReportConfig(fraud_mode="without")
    with pytest.raises(ValueError, match="months_back"):
        ReportConfig(months_back=())


@given(st.dates(date(1990, 1, 1), date(2100, 1, 1)), st.integers(0, 120))
def test_balance_date_is_a_month_end_before_the_run(run_date, months_back):
    day = balance_date_of(run_date, months_back)
    next_day = day + timedelta(days=1)
    assert next_day.day == 1
    months = (run_date.year - day.year) * 12 + run_date.month - day.month
    assert months == months_back + 1
