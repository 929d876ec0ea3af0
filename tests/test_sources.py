"""Loaders, history and CSV."""

import tempfile
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import installment
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from arrears import schemas
from arrears.schemas import COUNT_REPORT_COLUMNS, LOAN, REPORT, REPORT_COLUMNS
from arrears.sources.history import append_history, read_history, rebuild_history, upsert_history
from arrears.sources.report_csv import export_raw_csv, read_raw_counts, read_raw_reports
from arrears.sources.scratch import scratch_path, stage
from arrears.sources.tables import (
    as_fraud,
    as_installments,
    as_loans,
    load_buckets,
    load_fraud,
    load_installments,
    load_loans,
)

DUE = date(2024, 2, 10)


def reports(spark, *days, first=1):
    row = [first, 2, 0.5, 1.25, 2.5, 0.1 + 0.2] * 5
    return spark.createDataFrame([(day, *row) for day in days], REPORT)


def days_of(frame):
    return sorted(row.Balance_Date for row in frame.collect())


JAN, FEB, MAR = date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31)


@pytest.mark.parametrize("format", ["parquet", "orc", "csv", "json"])
def test_installments_load_alike_from_every_format(spark, tmp_path, format):
    rows = [installment("007", 1, DUE, 1, None, ("1.5", None, "2.5"))]
    frame = spark.createDataFrame(rows, schemas.INSTALLMENTS)
    writer = frame.write.format(format)
    (writer.option("header", True) if format == "csv" else writer).save(str(tmp_path / "t"))
    loaded = load_installments(spark, str(tmp_path / "t"), format=format)
    assert loaded.collect() == frame.collect()
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in schemas.INSTALLMENTS]


def test_loan_and_bucket_loaders_cast_stored_types(spark, tmp_path):
    spark.sql(
        "select 12L as loanAccountNumber, 1L as flagDisbursement, 'Current' as loanPaidStatus,"
        " date'2022-03-04' as disbursementDateTime, 'x' as extra"
    ).write.parquet(str(tmp_path / "loans"))
    (row,) = load_loans(spark, str(tmp_path / "loans")).collect()
    assert tuple(row) == ("12", 1, "Current", datetime(2022, 3, 4))

    spark.sql(
        "select '1' as loanAccountNumber, timestamp'2024-03-31 17:00:00' as bucketDate, 1.23456d as Loan_Principal,"
        " 2 as Loan_Interest, null as Overdue_Penalty, 1.5bd as Loan_Fee, 9 as Total_Outstanding_Amount,"
        " 91L as Max_current_DPD"
    ).write.parquet(str(tmp_path / "buckets"))
    (row,) = load_buckets(spark, str(tmp_path / "buckets")).collect()
    assert row.bucketDate == MAR
    assert row.Loan_Principal == Decimal("1.23456") and row.Max_current_DPD == 91


def test_column_names_may_differ_in_case(spark):
    frame = spark.sql(
        "select '1' as LOANACCOUNTNUMBER, 1 as flagdisbursement, '' as LoanPaidStatus,"
        " null as DisbursementDatetime"
    )
    assert as_loans(frame).columns == schemas.LOANS.fieldNames()


def test_load_from_a_table(spark):
    spark.createDataFrame([("1", 1, None, None)], schemas.LOANS).createOrReplaceTempView("loan_master")
    assert load_loans(spark, "loan_master", format="table").count() == 1


def test_penalty_stored_as_float_is_not_cut_before_rounding(spark):
    rows = spark.createDataFrame([installment("1", 1, DUE)], schemas.INSTALLMENTS)
    stored = rows.withColumn("Penalty", F.lit(2.49996))
    assert as_installments(stored).first().Penalty == Decimal("2.49996")


def test_missing_column_is_an_error(spark):
    frame = spark.createDataFrame([("1", 1)], f"{LOAN} string, installmentNumber int")
    with pytest.raises(ValueError, match="installmentDueDate"):
        as_installments(frame)


def test_fraud_list_keeps_its_columns_and_checks_its_key(spark, tmp_path):
    frame = spark.createDataFrame([("12", "x"), ("13", "y")], "ACCOUNTNUMBER string, note string")
    frame.write.option("header", True).csv(str(tmp_path / "fraud"))
    loaded = load_fraud(spark, str(tmp_path / "fraud"), "ACCOUNTNUMBER", format="csv")
    assert loaded.columns == ["ACCOUNTNUMBER", "note", "fraud_loan"]
    assert sorted(r.fraud_loan for r in loaded.collect()) == [12, 13]
    with pytest.raises(ValueError, match=LOAN):
        load_fraud(spark, str(tmp_path / "fraud"), format="csv")


def test_null_keys_fail_or_are_dropped(spark):
    fraud = spark.createDataFrame([(1,), (None,)], f"{LOAN} bigint")
    with pytest.raises(PySparkException, match="null fraud_loan"):
        as_fraud(fraud).collect()
    assert as_fraud(fraud, null_keys="drop").count() == 1

    rows = spark.createDataFrame([installment(None, 1, DUE), installment("1", 1, DUE)], schemas.INSTALLMENTS)
    with pytest.raises(PySparkException, match=f"null {LOAN}"):
        as_installments(rows).groupBy(LOAN).count().collect()
    assert as_installments(rows, null_keys="drop").count() == 1
    with pytest.raises(ValueError, match="null_keys"):
        as_installments(rows, null_keys="ignore")


def test_append_doubles_a_month_run_twice(spark, tmp_path):
    path = str(tmp_path / "history")
    append_history(reports(spark, JAN, FEB), path)
    append_history(reports(spark, FEB), path)
    assert days_of(read_history(spark, path)) == [JAN, FEB, FEB]


def test_upsert_replaces_only_its_months(spark, tmp_path):
    path = str(tmp_path / "history")
    upsert_history(reports(spark, JAN, FEB), path)
    upsert_history(reports(spark, FEB, MAR, first=9), path)
    upsert_history(reports(spark, FEB, MAR, first=9), path)
    found = {r.Balance_Date: r.firstpaymentdefaultcnt for r in read_history(spark, path).collect()}
    assert found == {JAN: 1, FEB: 9, MAR: 9}
    assert read_history(spark, path).columns == REPORT_COLUMNS
    assert read_history(spark, path).count() == 3


def test_rebuild_drops_older_months_whatever_the_session_says(spark, tmp_path):
    path = str(tmp_path / "history")
    append_history(reports(spark, JAN, FEB), path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rebuild_history(reports(spark, MAR), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert days_of(read_history(spark, path)) == [MAR]


def test_csv_keeps_every_digit(spark, tmp_path):
    report = reports(spark, JAN, FEB).withColumn("firstpaymentdefault", F.lit(None).cast("double"))
    export_raw_csv(report, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    back = read_raw_reports(spark, str(tmp_path / "csv"))
    assert sorted(back.collect()) == sorted(report.collect())


def write_csv(path, names, *lines):
    path.write_text("\n".join([",".join(names), *lines]) + "\n")
    return str(path)


VALUES = ",".join(["3,4,0.75,1065.5,2500,0.4262"] * 5)


def test_both_date_styles(spark, tmp_path):
    iso = write_csv(tmp_path / "iso.csv", REPORT_COLUMNS, f"2024-03-31,{VALUES}")
    dashed = write_csv(tmp_path / "dashed.csv", REPORT_COLUMNS, f"31-01-2024,{VALUES}", f"29-02-2024,{VALUES}")
    rows = read_raw_reports(spark, [iso, dashed])
    assert days_of(rows) == [JAN, FEB, MAR]
    assert rows.first().firstpaymentTotal_Outstanding_Amount == 1065.5


@pytest.mark.parametrize("day", ["03/31/2024", ""])
def test_other_date_styles_fail(spark, tmp_path, day):
    path = write_csv(tmp_path / "bad.csv", REPORT_COLUMNS, f"{day},{VALUES}")
    with pytest.raises(PySparkException, match="not a balance date"):
        read_raw_reports(spark, path).collect()


def test_foreign_headers_and_values_fail(spark, tmp_path):
    swapped = [REPORT_COLUMNS[0], REPORT_COLUMNS[2], REPORT_COLUMNS[1], *REPORT_COLUMNS[3:]]
    path = write_csv(tmp_path / "swapped.csv", swapped, f"2024-03-31,{VALUES}")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw_reports(spark, path).collect()
    path = write_csv(tmp_path / "text.csv", REPORT_COLUMNS, "2024-03-31,many," + VALUES[2:])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_raw_reports(spark, path).collect()


def test_count_files_have_no_date(spark, tmp_path):
    values = ",".join(["3,4,0.75"] * 5)
    path = write_csv(tmp_path / "counts.csv", COUNT_REPORT_COLUMNS[1:], values)
    (row,) = read_raw_counts(spark, path).collect()
    assert len(row) == 15 and row.total90plus2022defaultrate == 0.75


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    path = scratch_path(spark, "x")
    assert path.startswith(f"{shared}/arrears/x-") and path != scratch_path(spark, "x")
    staged = stage(reports(spark, JAN), "report")
    assert staged.collect() == reports(spark, JAN).collect()
    assert all(f"{shared}/arrears/report-" in path for path in staged.inputFiles())


@pytest.mark.parametrize(
    "conf, expected",
    [
        ({"spark.checkpoint.dir": "hdfs://shared/", "spark.master": "yarn"}, "hdfs://shared/arrears/"),
        ({"spark.master": "local[2]"}, f"{tempfile.gettempdir()}/arrears/"),
        ({"spark.master": "yarn"}, None),
        ({}, None),
        ({"spark.master": "local-cluster[2,1,1024]"}, None),
        ({"spark.master": "yarn", "context": "hdfs://context"}, "hdfs://context/arrears/"),
    ],
)
def test_scratch_never_falls_back_to_a_local_folder_on_a_cluster(conf, expected):
    class Session:
        class conf:
            get = staticmethod(lambda key, default: conf.get(key, default))

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: conf.get("context"))

    if expected:
        assert scratch_path(Session, "x").startswith(expected)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(Session, "x")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_amounts_survive_loading_or_fail(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)

    def load(principal, flag="1"):
        columns = (
            f"'1' AS loanAccountNumber, 1 AS installmentNumber, date'2024-01-01' AS installmentDueDate, {flag} AS isDelinquent,"
            f" 0 AS isCurrentDelinquent, {principal} AS Principal, 0d AS Interest, 0d AS Penalty, 0d AS Principal_paid,"
            " 0d AS Interest_paid, 0d AS Penalty_paid"
        )
        (row,) = as_installments(spark.sql(f"SELECT {columns}")).collect()
        return row

    try:
        assert load("1e15D").Principal == Decimal("1000000000000000")
        assert load("0.00004D").Principal == Decimal("0.00004")
        assert load("0.3333333333333333D").Principal == Decimal("0.3333333333333333")
        assert load("'12.34567'").Principal == Decimal("12.34567")
        assert load("CAST(NULL AS DOUBLE)").Principal is None
        for bad in ("1e30D", "double('NaN')", "'many'"):
            with pytest.raises(Exception, match="Principal is no"):
                load(bad)
        with pytest.raises(Exception, match="isDelinquent is no"):
            load("1D", flag="'yes'")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
