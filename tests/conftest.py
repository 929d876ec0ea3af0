"""Shared Spark session and hand-made loan books."""

from __future__ import annotations

import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from arrears import schemas  # noqa: E402
from arrears.session import local_session  # noqa: E402
from arrears.sources.tables import LoanBook, as_buckets, as_fraud, as_installments, as_loans  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)


@pytest.fixture(scope="session")
def duck(tables_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tables_dir}/{name}.parquet'")
    return connection


def installment(loan, number, due, delinquent=0, current=0, amounts=(100, 10, None), paid=(0, 0, 0)):
    return (loan, number, due, delinquent, current, *map(money, amounts), *map(money, paid))


def loan(number, flag=1, status="Current", disbursed=datetime(2022, 5, 1)):
    return (number, flag, status, disbursed)


def bucket(number, day, amounts=(1000, 100, 10, 1), outstanding=500, dpd=0):
    return (number, day, *map(money, amounts), money(outstanding), dpd)


def money(value):
    return None if value is None else Decimal(str(value))


def make_book(spark, installments=(), loans=(), buckets=(), fraud=()) -> LoanBook:
    return LoanBook(
        installments=as_installments(spark.createDataFrame(list(installments), schemas.INSTALLMENTS)),
        loans=as_loans(spark.createDataFrame(list(loans), schemas.LOANS)),
        buckets=as_buckets(spark.createDataFrame(list(buckets), schemas.BUCKETS)),
        fraud=as_fraud(spark.createDataFrame([(n,) for n in fraud], f"{schemas.LOAN} bigint")),
    )


def one_row(frame) -> dict:
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0].asDict()


MARCH = date(2024, 3, 31)
"""Balance date of run dates in April 2024, used by the hand-made books."""
