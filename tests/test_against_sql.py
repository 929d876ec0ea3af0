"""The one-pass plans against one-subquery-per-set SQL, on random loan books and on the test tables."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import duckdb
import pytest
from conftest import bucket, installment, loan, make_book
from pyspark.sql import functions as F

from arrears.checks import oracle
from arrears.checks.queries import queries
from arrears.config import ReportConfig
from arrears.operators.loan_sets import BALANCE_KINDS, installment_balances
from arrears.plans.reports import full_report
from arrears.schemas import REPORT_COLUMNS, SEGMENT_COLUMNS

RUN_DATE = date(2024, 4, 5)


def random_book(spark, seed, hot=False):
    """Nulls, repeated keys, gaps; ``hot`` gives one loan a third of all rows."""
    pick = random.Random(seed)
    numbers = [str(n) for n in range(1, 81)]

    def some_loan():
        return "7" if hot and pick.random() < 1 / 3 else pick.choice(numbers)

    def amount():
        return pick.choice([None, 0, "2.5", round(pick.uniform(0, 5000), 4)])

    def flag():
        return pick.choice([None, 0, 0, 1])

    month_ends = ReportConfig(run_date=RUN_DATE, months_back=(0, 1, 2, 3)).balance_dates
    due_days = [date(2023, 10, 1) + timedelta(days=n) for n in range(240)] + month_ends
    installments = [
        installment(
            some_loan(),
            pick.choice([0, 1, 1, 2, 3, None]),
            pick.choice(due_days),
            flag(),
            flag(),
            [amount() for _ in range(3)],
            [amount() for _ in range(3)],
        )
        for _ in range(400)
    ]
    loans = [
        loan(
            pick.choice([*numbers, None]),
            pick.choice([None, 0, 1, 1, 1]),
            pick.choice([None, "Current", "Current", "Settled", "Completed", "Written Off"]),
            pick.choice([None, datetime(2021, 12, 31), datetime(2022, 1, 1), datetime(2022, 12, 31, 23)]),
        )
        for _ in range(120)
    ]
    buckets = [
        bucket(
            None if pick.random() < 0.05 else some_loan(),
            pick.choice([*month_ends, date(2024, 3, 30)]),
            [amount() for _ in range(4)],
            amount(),
            pick.choice([None, 0, 90, 91, 400]),
        )
        for _ in range(500)
    ]
    fraud = [pick.randint(1, 100) for _ in range(30)]
    return make_book(spark, installments, loans, buckets, fraud)


def in_duckdb(book):
    connection = duckdb.connect()
    for name, frame in vars(book).items():
        connection.register(name, frame.toArrow())
    return connection


def rows_of(relation):
    return sorted(tuple(row) for row in relation)


@pytest.mark.parametrize("seed, hot", [(1, False), (2, False), (3, True)])
@pytest.mark.parametrize("fraud_mode", ["exclude", "only"])
def test_report_of_random_book(spark, seed, hot, fraud_mode):
    book = random_book(spark, seed, hot)
    config = ReportConfig(run_date=RUN_DATE, months_back=(0, 1, 2, 3), fraud_mode=fraud_mode)
    sql = " UNION ALL ".join(oracle.report(day, fraud_mode, 2022) for day in config.balance_dates)
    expected = rows_of(in_duckdb(book).sql(sql).fetchall())

    together = full_report(book, config).collect()
    one_by_one = [
        full_report(book, ReportConfig(run_date=RUN_DATE, months_back=(k,), fraud_mode=fraud_mode)).collect()[0]
        for k in range(4)
    ]
    assert rows_of(together) == expected
    assert rows_of(one_by_one) == expected
    assert sum(row.firstpaymentdefaultcnt for row in together) > 0
    assert sum(row.cntsecondinstallmentdefault for row in together) > 0


@pytest.mark.parametrize("kind", BALANCE_KINDS)
def test_balances_of_random_book(spark, kind):
    book = random_book(spark, 4)
    day = date(2024, 3, 31)
    expected = in_duckdb(book).sql(oracle.balances(kind, day)).fetchall()
    found = installment_balances(book.installments, kind, day).selectExpr(
        "loanAccountNumber", "double(totalamount)", "double(outstandingamount)"
    )
    assert rows_of(found.collect()) == rows_of(expected) != []


def test_invariants_of_random_book(spark):
    book = random_book(spark, 5)
    modes = {
        mode: {
            row.Balance_Date: row.asDict()
            for row in full_report(
                book, ReportConfig(run_date=RUN_DATE, months_back=(0, 1, 2, 3), fraud_mode=mode)
            ).collect()
        }
        for mode in ("exclude", "only")
    }
    for day, without in modes["exclude"].items():
        only = modes["only"][day]
        for defaulted, observed, count_rate, owed, total, amount_rate in SEGMENT_COLUMNS.values():
            assert without[count_rate] == pytest.approx(without[defaulted] / without[observed], rel=1e-15)
            assert without[amount_rate] == pytest.approx(without[owed] / without[total], rel=1e-15)
            assert without[defaulted] <= without[observed]
        first, overall, fraud = (
            SEGMENT_COLUMNS[n] for n in ("first_payment", "overall_90plus", "fraud_90plus")
        )
        assert without[first[1]] == without[overall[1]] and without[first[4]] == without[overall[4]]
        for i in (0, 1):
            assert without[fraud[i]] <= without[overall[i]]
        for i in (0, 1, 3, 4):
            parts = (without[fraud[i]] or 0) + (only[fraud[i]] or 0)
            assert parts == pytest.approx(without[overall[i]])


def test_literal_form_runs_on_spark_too(spark):
    book = random_book(spark, 6)
    for name, frame in vars(book).items():
        frame.createOrReplaceTempView(name)
    config = ReportConfig(run_date=RUN_DATE)
    literal = spark.sql(oracle.report(config.balance_dates[0], "exclude", 2022))
    assert literal.columns == REPORT_COLUMNS
    assert literal.collect() == full_report(book, config).collect()


@pytest.mark.parametrize("name", queries())
def test_registered_query(spark, duck, tables_dir, name):
    found = queries()[name](spark, tables_dir)
    relation = duck.sql(oracle.oracle_sql()[name])
    expected = relation.fetchall()
    assert found.columns == relation.columns
    rows = [tuple(row) for row in found.collect()]
    if "ORDER BY" in oracle.oracle_sql()[name]:
        assert rows == expected
    assert rows_of(rows) == rows_of(expected) != []


@pytest.fixture(scope="module")
def hot_dir(spark, tables_dir, tmp_path_factory):
    """The test tables with a third of the line items on one order and of the orders on one customer."""
    path = str(tmp_path_factory.mktemp("hot"))
    third = F.rand(11) < 1 / 3
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_custkey"), ("customer", None)):
        table = spark.read.parquet(f"{tables_dir}/{name}.parquet")
        if key:
            hot = table.agg(F.min(key)).first()[0]
            table = table.withColumn(key, F.when(third, hot).otherwise(F.col(key)))
        table.repartition(4).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", ["kri_report_full", "kri_backfill", "inst_second_plus", "fraud_accounts"])
def test_hot_keys(spark, hot_dir, name):
    connection = duckdb.connect()
    for table in ("lineitem", "orders", "customer"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{hot_dir}/{table}.parquet/*.parquet'")
    expected = connection.sql(oracle.oracle_sql()[name]).fetchall()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = queries()[name](spark, hot_dir).collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert rows_of(found) == rows_of(expected) != []


def test_every_query_has_sql():
    assert list(queries()) == list(oracle.oracle_sql())
