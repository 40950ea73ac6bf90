"""Whole-job tests: re-runs, month order, failures and their repair."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from filigree.plans import filings as J
from filigree.sources.schemas import register_tables
from filigree.sources.tables import Table

T1, T2, T3 = datetime(2025, 1, 1), datetime(2025, 2, 1), datetime(2025, 3, 1)


def filing(name="Acme Ltd", turnover="1,234", director="Jane Roe", extra=""):
    return f"""<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL"><body>
<ix:header><xbrli:context xmlns:xbrli="x" id="c"><xbrli:period><xbrli:startDate>2024-01-01</xbrli:startDate>
<xbrli:endDate>2024-12-31</xbrli:endDate></xbrli:period></xbrli:context></ix:header>
<ix:nonNumeric name="uk:EntityCurrentLegalOrRegisteredName" contextRef="c"> {name}&#160;</ix:nonNumeric>
<ix:nonNumeric name="uk:NameEntityOfficer" contextRef="c">{director}</ix:nonNumeric>
<ix:nonFraction name="uk:Turnover" contextRef="c" scale="3" sign="-">{turnover}</ix:nonFraction>
<h1>STRATEGIC REPORT</h1><p>We sold a great many things.</p><p>BALANCE SHEET</p>
{extra}</body></html>"""


def land(root, month, name, text):
    folder = root / month / "batch"
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def rows(table, spark, *cols):
    return sorted(tuple(r) for r in table.read(spark).select(*cols).collect())


def test_load_twice_in_either_order_and_repair(spark, tmp_path):
    landing = tmp_path / "landing"
    first, second = "Prod224_0086_00000001_20200229.html", "Prod224_0087_00000001_20210228.html"
    land(landing, "2021-01", first, filing(turnover="1"))
    land(landing, "2021-01", "Prod224_0086_00000002_20200229.html", "no markup here")
    land(landing, "2021-01", "Prod224_0086_00000003_20200229.html",
         "<html><p>nothing tagged</p></html>")
    land(landing, "2021-02", second, filing(turnover="2", extra=(
        '<ix:nonNumeric name="uk:AccountsType" format="ixt2:datemonthdayyearen" '
        'contextRef="c">May 1, 2020</ix:nonNumeric>')))

    results = []
    for order in (("2021-01", "2021-02"), ("2021-02", "2021-01")):
        root = str(tmp_path / "-".join(order))
        tables = register_tables(root)
        for month, at in zip(order, (T1, T2)):
            J.filings_load(spark, str(landing), root, months=[month], at=at)
        results.append((
            rows(tables["financials"], spark, "company_number", "metric", "value", "period",
                 "fiscal_period_new", "data_scope", "source_file", "ch_upload"),
            rows(tables["directors"], spark, "company_number", "director_name", "ch_upload"),
            rows(tables["reports"], spark, "company_name", "section", "text", "ch_upload"),
            rows(tables["file_ledger"], spark, "source_file", "ch_upload", "status")))
    assert results[0] == results[1]
    facts, directors, reports, ledger = results[0]
    assert [f[2] for f in facts] == [-2000.0, -1000.0]
    assert facts[0][3:6] == ("2024-01-01 to 2024-12-31", 2024, "single_entity")
    assert directors == [("00000001", "Jane Roe", "Feb-21")]
    assert reports == [
        ("Acme Ltd", "strategic_report", "We sold a great many things.", "Feb-21")]
    assert [s for _, _, s in ledger] == ["success", "failed", "success", "warning"]

    first_root = str(tmp_path / "2021-01-2021-02")
    tables = register_tables(first_root)
    # first-insert time stays although the row was updated a month later
    assert rows(tables["directors"], spark, "loaded_at") == [(T1,)]
    comments = {r.source_file: r.comment for r in tables["file_ledger"].read(spark).collect()}
    assert comments["Prod224_0086_00000003_20200229"] == "Empty result"
    assert "[1] Format ixt2:datemonthdayyearen" in comments[second[:-5]]
    months = {r.ch_upload: r for r in tables["month_ledger"].read(spark).collect()}
    assert (months["Jan-21"].files_processed, months["Jan-21"].files_failed) == (2, 1)
    assert months["Jan-21"].zip_filename == "Accounts_Monthly_Data-January2021.zip"

    # a second run finds nothing new and changes no data
    J.filings_load(spark, str(landing), first_root, at=T3)
    assert rows(tables["financials"], spark, "company_number", "metric", "value", "period",
                "fiscal_period_new", "data_scope", "source_file", "ch_upload") == facts
    months = {r.ch_upload: r for r in tables["month_ledger"].read(spark).collect()}
    assert (months["Jan-21"].status, months["Jan-21"].files_processed) == ("completed", 0)

    # repair: still broken once, then mended
    J.reprocess_failed(spark, str(landing), first_root, at=T3)
    held = tables["quarantine"].read(spark).where("status = 'failed'").collect()
    assert [(h.attempts, h.content) for h in held] == [(1, "no markup here")]
    land(landing, "2021-01", "Prod224_0086_00000002_20200229.html", filing(name="B"))
    J.reprocess_failed(spark, str(landing), first_root, at=T3)
    assert tables["quarantine"].read(spark).where("status = 'failed'").count() == 0
    assert ("00000002", "Jane Roe", "Jan-21") in rows(
        tables["directors"], spark, "company_number", "director_name", "ch_upload")
    summary = {r.ch_upload: r for r in J.run_summary(
        tables["file_ledger"].read(spark), tables["month_ledger"].read(spark)).collect()}
    assert summary["Jan-21"].success_rate == "100.00%"
    assert summary["Feb-21"].success_rate == "N/A"

    fields = rows(tables["fields"], spark, "company_number", "field", "value", "ch_upload")
    assert ("00000001", "company_name", "Acme Ltd", "Jan-21") in fields
    assert ("00000001", "is_consolidated", "no", "Jan-21") in fields

    plan = J.backfill_plan(spark, tables["month_ledger"].read(spark),
                           date(2020, 12, 5), date(2021, 3, 1))
    assert [r.ch_upload for r in plan.collect()] == ["Dec-20", "Mar-21"]


def test_monthly_load_takes_previous_month(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    land(landing, "2020-12", "Prod224_2012_00000009_20201231.html", filing())
    J.monthly_load(spark, str(landing), root, date(2021, 1, 7), at=T1)
    J.monthly_load(spark, str(landing), root, date(2021, 1, 9), at=T2)
    (row,) = register_tables(root)["month_ledger"].read(spark).collect()
    assert (row.ch_upload, row.status, row.started_at) == ("Dec-20", "completed", T1)


def test_table_of_filings_gives_what_files_give(spark, tmp_path):
    landing = tmp_path / "landing"
    for i in range(3):
        land(landing, "2021-01", f"Prod224_0086_0000000{i}_20200229.html", filing(turnover=str(i)))
    stored = str(tmp_path / "stored")
    J.scan_filings(spark, str(landing)).write.partitionBy("ch_upload").parquet(stored)
    table = spark.read.parquet(stored)
    for at in (T1, T2):  # the second run finds nothing new
        J.filings_table_load(table, str(tmp_path / "root"), at=at)
    tables = register_tables(str(tmp_path / "root"))
    assert sorted(r.value for r in tables["financials"].read(spark).collect()) == [-2000.0, -1000.0, 0.0]
    (month,) = tables["month_ledger"].read(spark).collect()
    assert (month.status, month.files_processed, month.started_at) == ("completed", 0, T2)


def test_failed_run_is_recorded_and_can_be_repeated(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    land(landing, "2021-01", "Prod224_0086_00000001_20200229.html", filing())

    def lost(*_):
        raise RuntimeError("lost in the middle")

    # the facts are written, the ledger is not
    monkeypatch.setattr(J, "outcomes", lost)
    try:
        J.filings_load(spark, str(landing), root, at=T1)
        raise AssertionError("should have failed")
    except RuntimeError as failure:
        assert "lost" in str(failure)
    monkeypatch.undo()
    tables = register_tables(root)
    (month,) = tables["month_ledger"].read(spark).collect()
    assert (month.status, month.files_failed) == ("failed", 1)
    J.filings_load(spark, str(landing), root, at=T2)
    assert tables["financials"].read(spark).count() == 1
    (month,) = tables["month_ledger"].read(spark).collect()
    assert (month.status, month.files_processed) == ("completed", 1)


def test_one_broken_filing_keeps_its_neighbours(spark):
    good = [(f"p{i}", f"f{i}", "Jan-21", filing()) for i in range(5)]
    df = spark.createDataFrame(
        good + [("px", "fx", "Jan-21", None)],
        "path string, source_file string, ch_upload string, content string").coalesce(1)
    parsed = J.parse(df)
    assert parsed.where(F.col("error").isNotNull()).count() == 1
    assert J.financials(J.fact_table(parsed)).count() == 5


def test_label_is_that_of_the_folder_below_the_landing_root(spark, tmp_path):
    landing, root = tmp_path / "2019-07" / "landing", str(tmp_path / "root")
    land(landing, "2021-01", "Prod224_0086_00000001_20200229.html", filing())
    land(landing, "incoming", "Prod224_0086_00000002_20200229.html", filing())
    land(landing, "2021-13", "Prod224_0086_00000003_20200229.html", filing())
    with pytest.warns(UserWarning, match="incoming"):
        J.filings_load(spark, str(landing), root, at=T1)
    tables = register_tables(root)
    assert rows(tables["month_ledger"], spark, "batch_id", "status", "files_processed") == [("accounts_Jan-21", "completed", 1)]
    assert rows(tables["file_ledger"], spark, "source_file", "ch_upload") == [("Prod224_0086_00000001_20200229", "Jan-21")]


def test_known_filings_are_not_opened(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    known, new = "Prod224_0086_00000001_20200229.html", "Prod224_0086_00000002_20200229.html"
    land(landing, "2021-01", known, filing())
    J.filings_load(spark, str(landing), root, at=T1)
    land(landing, "2021-01", new, filing())
    opened, read = [], J.read_contents

    def spy(listed):
        opened.extend(r.path for r in listed.collect())
        return read(listed)

    monkeypatch.setattr(J, "read_contents", spy)
    J.filings_load(spark, str(landing), root, at=T2)
    assert [os.path.basename(p) for p in opened] == [new]
    assert register_tables(root)["financials"].read(spark).count() == 2


def test_months_fail_apart_and_leave_finished_ones(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    land(landing, "2021-01", "Prod224_0086_00000001_20200229.html", filing())
    J.filings_load(spark, str(landing), root, at=T1)
    land(landing, "2021-02", "Prod224_0087_00000002_20200229.html", filing())
    land(landing, "2021-03", "Prod224_0088_00000003_20200229.html", filing())
    whole = J._commit_in

    def breaks(spark_, work, tables, filings, months, *rest):
        if "Feb-21" in months:
            spark_.range(1).write.parquet(f"{work}/parsed")
            raise RuntimeError("broken month")
        return whole(spark_, work, tables, filings, months, *rest)

    monkeypatch.setattr(J, "_commit_in", breaks)
    with pytest.raises(RuntimeError, match="broken month"):
        J.filings_load(spark, str(landing), root, at=T2)
    tables = register_tables(root)
    assert rows(tables["month_ledger"], spark, "ch_upload", "status", "files_processed", "files_failed") == [
        ("Feb-21", "failed", 0, 1), ("Jan-21", "completed", 0, 0), ("Mar-21", "completed", 1, 0)]
    assert os.listdir(f"{root}/_work") == []  # nothing is left, of the failed load either


def test_whole_comments_and_all_warnings_are_kept(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    odd = "".join(f'<ix:nonNumeric name="uk:X{k}" format="ixt9:odd{k}" contextRef="c">x</ix:nonNumeric>' for k in range(200))
    odd += '<ix:nonFraction name="uk:Debtors" contextRef="d">1d</ix:nonFraction>'
    odd += '<xbrli:context xmlns:xbrli="x" id="d"><xbrli:instant>31 December 2020</xbrli:instant></xbrli:context>'
    land(landing, "2021-01", "Prod224_0086_00000001_20200229.html", filing(extra=odd))
    J.filings_load(spark, str(landing), root, at=T1)
    tables = register_tables(root)
    (held,) = tables["quarantine"].read(spark).collect()
    (entry,) = tables["file_ledger"].read(spark).collect()
    assert held.comment.endswith("[200] Format ixt9:odd199 not implemented")
    assert entry.comment == held.comment[:2000] and entry.status == "warning"
    told = rows(tables["warnings"], spark, "n", "warning")
    assert len(told) == 202 and told[-2:] == [(201, "Date 31 December 2020 not understood"), (202, "Number 1d not understood")]
    assert [r.value for r in tables["financials"].read(spark).where("metric = 'debtors'").collect()] in ([], [None])


def test_tables_without_spark_success_marks(spark, tmp_path):
    table = Table(f"{tmp_path}/t", "a bigint")
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(key, "false")
    try:
        for n in (1, 2, 3):
            table.write(spark.range(n).toDF("a"))
    finally:
        conf.unset(key)
    assert table.read(spark).count() == 3
    assert table.drop_superseded(spark, 2) == 1 and table.read(spark).count() == 3
    os.remove(f"{tmp_path}/_commits/00000003.json")  # not committed: not there
    assert table.read(spark).count() == 2
