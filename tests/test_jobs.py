"""Jobs that write."""

import os
from datetime import date
from pathlib import Path

import pytest
from conftest import MARCH, bucket, installment, loan, make_book

from arrears.config import ReportConfig
from arrears.plans.jobs import monthly_run, monthly_summary, rebuild
from arrears.sources.history import read_history, upsert_history
from arrears.sources.report_csv import export_raw_csv, read_raw_reports

RUN = date(2024, 4, 5)
FEBRUARY = date(2024, 2, 29)


@pytest.fixture
def book(spark):
    numbers = ["1", "2"]
    return make_book(
        spark,
        [installment(n, 1, date(2024, 2, 1), delinquent=1) for n in numbers],
        [loan(n) for n in numbers],
        [bucket(n, day) for n in numbers for day in (MARCH, FEBRUARY)],
    )


def counts(frame):
    return {row.Balance_Date: row.firstpaymentoverallobservation for row in frame.collect()}


def test_monthly_run_can_be_repeated(spark, book, tmp_path):
    history, csv = str(tmp_path / "history"), str(tmp_path / "csv")
    monthly_run(book, ReportConfig(run_date=date(2024, 3, 5)), history, str(tmp_path / "older"))
    for _ in range(2):
        report = monthly_run(book, ReportConfig(run_date=RUN), history, csv)
    assert counts(read_history(spark, history)) == {FEBRUARY: 2, MARCH: 2}
    assert read_history(spark, history).count() == 2
    assert read_raw_reports(spark, csv).collect() == report.collect()


def test_appending_run_is_not_repeatable(spark, book, tmp_path):
    history, csv = str(tmp_path / "history"), str(tmp_path / "csv")
    for _ in range(2):
        monthly_run(book, ReportConfig(run_date=RUN), history, csv, into_history="append")
    assert read_history(spark, history).count() == 2


def test_rebuild_replaces_everything(spark, book, tmp_path):
    history = str(tmp_path / "history")
    monthly_run(book, ReportConfig(run_date=date(2020, 1, 5)), history, str(tmp_path / "csv"))
    rebuild(book, ReportConfig(run_date=RUN, months_back=(0, 1)), history)
    assert counts(read_history(spark, history)) == {FEBRUARY: 2, MARCH: 2}


def test_summary_takes_the_newest_file_of_a_month(spark, book, tmp_path):
    history = str(tmp_path / "history")
    rebuild(book, ReportConfig(run_date=RUN, months_back=(0, 1, 2)), history)
    saved = read_history(spark, history)
    resaved = saved.filter("Balance_Date = '2024-02-29'").replace(2, 5, ["firstpaymentoverallobservation"])
    outdated = saved.filter("Balance_Date = '2024-03-31'").replace(2, 4, ["firstpaymentoverallobservation"])
    export_raw_csv(resaved, str(tmp_path / "csv" / "feb"))
    export_raw_csv(outdated, str(tmp_path / "csv" / "mar"))
    for name, shift in (("feb", 60), ("mar", -60)):
        for path in Path(tmp_path / "csv" / name).glob("*.csv"):
            age = path.stat().st_mtime + shift
            os.utime(path, (age, age))

    summary = monthly_summary(spark, csv=str(tmp_path / "csv" / "*"), history=history)
    rows = [(r.Balance_Date, r.firstpaymentoverallobservation) for r in summary.collect()]
    assert rows == [(MARCH, 2), (FEBRUARY, 5), (date(2024, 1, 31), 0)]
    assert summary.columns == saved.columns


def test_summary_needs_a_source(spark):
    with pytest.raises(ValueError):
        monthly_summary(spark)


class Stopped(Exception):
    pass


def stop(*_, **__):
    raise Stopped


@pytest.mark.parametrize("at", ["arrears.plans.jobs.export_raw_csv", "arrears.sources.history._write_list"])
def test_a_monthly_run_that_stops_leaves_the_history(spark, book, tmp_path, monkeypatch, at):
    history, csv = str(tmp_path / "history"), str(tmp_path / "csv")
    monthly_run(book, ReportConfig(run_date=date(2024, 3, 5)), history, csv)
    before = read_history(spark, history)
    with monkeypatch.context() as broken, pytest.raises(Stopped):
        broken.setattr(at, stop)
        monthly_run(book, ReportConfig(run_date=RUN), history, csv)
    assert counts(before) == counts(read_history(spark, history)) == {FEBRUARY: 2}
    monthly_run(book, ReportConfig(run_date=RUN), history, csv)
    assert counts(read_history(spark, history)) == {FEBRUARY: 2, MARCH: 2}


def test_a_rebuild_that_stops_leaves_the_history(spark, book, tmp_path, monkeypatch):
    history = str(tmp_path / "history")
    rebuild(book, ReportConfig(run_date=RUN, months_back=(0, 1)), history)
    with monkeypatch.context() as broken, pytest.raises(Stopped):
        broken.setattr("arrears.sources.history._write_list", stop)
        rebuild(book, ReportConfig(run_date=date(2020, 1, 5)), history)
    assert counts(read_history(spark, history)) == {FEBRUARY: 2, MARCH: 2}


def test_a_list_that_was_not_finished_does_not_count(spark, book, tmp_path):
    history = tmp_path / "history"
    rebuild(book, ReportConfig(run_date=RUN), str(history))
    half = history / "versions" / "00000002"
    half.mkdir()
    (half / "part-00000.json").write_text("")
    assert counts(read_history(spark, str(history))) == {MARCH: 2}
    rebuild(book, ReportConfig(run_date=RUN, months_back=(1,)), str(history))
    assert counts(read_history(spark, str(history))) == {FEBRUARY: 2}


def test_readers_keep_what_they_began_to_read_and_old_folders_go(spark, book, tmp_path):
    history = tmp_path / "history"
    rebuild(book, ReportConfig(run_date=RUN), str(history))
    first = read_history(spark, str(history))
    rebuild(book, ReportConfig(run_date=RUN, months_back=(1,)), str(history))
    assert counts(first) == {MARCH: 2}
    for _ in range(2):
        rebuild(book, ReportConfig(run_date=RUN), str(history))
    assert len(list((history / "data").glob("run=*"))) == 2
    assert len(list((history / "versions").glob("[0-9]*"))) == 2


def test_a_plain_folder_of_months_becomes_a_history(spark, book, tmp_path):
    plain, history = str(tmp_path / "plain"), str(tmp_path / "history")
    rebuild(book, ReportConfig(run_date=RUN, months_back=(0, 1)), history)
    read_history(spark, history).write.partitionBy("Balance_Date").parquet(plain)
    assert counts(read_history(spark, plain)) == {FEBRUARY: 2, MARCH: 2}
    stale = read_history(spark, history).filter("Balance_Date = '2024-03-31'")
    upsert_history(stale.replace(2, 7, ["firstpaymentoverallobservation"]), plain)
    assert counts(read_history(spark, plain)) == {FEBRUARY: 2, MARCH: 7}
    assert counts(monthly_summary(spark, history=plain)) == {FEBRUARY: 2, MARCH: 7}
