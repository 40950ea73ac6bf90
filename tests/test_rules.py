"""One hand-made case per rule of the data model."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import sections as S
from filigree.functions import text as T
from filigree.functions import values as V
from filigree.operators import dedupe as D
from filigree.operators import facts as X
from filigree.operators import ledger as L
from filigree.operators import quality as Q
from filigree.operators import upserts as U

FACTS = "source_file string, ord int, tag string, value double, start_date string, end_date string, instant string"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_fixed_value_counts():
    assert (len(fv.METRIC_TAGS), len(set(fv.METRIC_TAGS.values()))) == (34, 25)
    assert (len(fv.FIELD_TAGS), len(fv.SNAPSHOT_HEADERS)) == (21, 26)


def test_first_metric_wins_before_nulls_go(spark):
    rows = [
        ("null first", 1, "Turnover", None), ("null first", 2, "Revenue", 5.0),
        ("two tags", 1, "Turnover", 5.0), ("two tags", 2, "Revenue", 6.0),
        ("unmapped", 1, "Unmapped", 1.0), ("unmapped", 2, "Revenue", 6.0)]
    facts = spark.createDataFrame([(*r, None, None, "2020-01-01") for r in rows], FACTS)
    got = X.first_metric_facts(facts, ["source_file"]).select("source_file", "metric", "value")
    assert sorted(tuple(r) for r in got.collect()) == [
        ("two tags", "revenue", 5.0), ("unmapped", "revenue", 6.0)]


def test_related_party_texts_and_names_so_far(spark):
    name, rp = fv.COMPANY_NAME_TAG, fv.RELATED_PARTY_TAG
    rows = [(1, rp, "x" * 21), (2, name, "A"), (3, rp, "y" * 21), (4, name, "B"), (5, rp, "z" * 20),
            (6, name, "")]
    facts = spark.createDataFrame([("f", *r) for r in rows], "source_file string, ord int, tag string, value string")
    texts = X.related_party_texts(facts, ["source_file"]).orderBy("ord").collect()
    assert [(t.company_name, t.text[0]) for t in texts] == [("", "x"), ("A", "y")]
    fields = X.field_rows(facts).orderBy("ord").collect()
    assert [(f.field, f.value) for f in fields] == [
        ("company_name", "A"), ("company_name", "B"), ("related_party_xbrl", "z" * 20)]
    last = D.last_value_per_key(facts, ["source_file"], F.when(
        (F.col("tag") == name) & (F.col("value") != ""), F.col("value")), "ord", "name")
    assert last.first()["name"] == "B"


def test_directors_are_distinct_trimmed_and_not_empty(spark):
    facts = spark.createDataFrame(
        [("f", i, fv.DIRECTOR_TAG, v) for i, v in enumerate(["X", " X\xa0", "", None, "Y"])],
        "source_file string, ord int, tag string, value string"
    ).withColumn("value", T.text_value(F.col("value")))
    got = X.director_rows(facts, ["source_file"]).orderBy("ord").collect()
    assert [(g.ord, g.director_name) for g in got] == [(0, "X"), (4, "Y")]


@pytest.mark.parametrize("content, expected", [
    ("GroupCompanyDataDimension Consolidated", ("yes", "consolidated")),
    ("Group\xa0ACCOUNTS", ("has_group_but_xbrl_is_parent", "parent_only")),
    ("APConsolidation consolidated financial statements", ("has_group_but_xbrl_is_parent", "parent_only")),
    ("GroupCompanyDataDimension", ("no", "single_entity"))])
def test_consolidation_class(spark, content, expected):
    group = T.consolidation_class(F.lit(content))
    assert one(spark, group, T.data_scope(group)) == expected


def test_periods(spark):
    df = spark.createDataFrame(
        [(1, "2025-06-30", None, None), (2, None, "2024-07-01", "2025-06-30"), (3, None, "2024-07-01", None)],
        "i int, instant string, start_date string, end_date string")
    got = X.with_period(df).orderBy("i").select(
        "period", "account_closing_date_last_year", "fiscal_period_new").collect()
    day = date(2025, 6, 30)
    assert [tuple(r) for r in got] == [
        ("as at 2025-06-30", day, 2025), ("2024-07-01 to 2025-06-30", day, 2025), ("", None, None)]
    no = F.lit(None).cast("string")
    assert one(spark, T.closing_day(F.lit("as at 2020-01-31 "), no, no),
               T.closing_day(F.lit("2019-01-01 to 2020-01-31"), no, no),
               T.fiscal_year(F.lit("abcd-01"))) == ("2020-01-31", "2020-01-31", None)


@pytest.mark.parametrize("stem, expected", [
    ("A_B", ("UNKNOWN", None, None)),
    ("Prod224_2601_00039175_20250630", ("00039175", date(2025, 6, 30), "Jan-26")),
    ("Prod224_0086_00039175_20251345", ("00039175", None, None)),
    ("Prod224_260_1_2025063", ("1", None, None)),
    ("Prod224_2113_1", ("1", None, None))])
def test_file_names(spark, stem, expected):
    name = T.file_stem(F.lit(f"file:/landing/2021-01/x.y/{stem}.html"))
    assert one(spark, T.company_number(name), T.filing_date(name), T.batch_label(name)) == expected


def test_months(spark):
    day = F.lit("2021-01-15").cast("date")
    assert one(
        spark, T.month_label(day), T.archive_name(day), T.snapshot_batch_id(day),
        T.snapshot_label(F.lit("Data-2021-01-01.zip")), T.snapshot_label(F.lit("other.zip")),
        T.previous_month(day), T.label_month(F.lit("Jan-21")), T.label_month(F.lit("nonsense")),
        T.directory_label(F.lit("s3://b/landing/2021-12/a/b.html"))) == (
        "Jan-21", "Accounts_Monthly_Data-January2021.zip", "company_data_2021-01-01", "January-2021",
        "other.zip", date(2020, 12, 1), date(2021, 1, 1), None, "Dec-21")


def test_newest_month_survives_and_first_load_time_stays(spark):
    schema = "company_number string, director_name string, filing_date date, source_file string, ch_upload string, loaded_at timestamp"
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 2, 1)
    rows = [("1", "X", date(2020, 1, 1), "a", "Jan-21", t1), ("1", "X", None, "b", "Feb-21", t2)]
    for old, new in (rows, rows[::-1]):
        merged = U.upsert_latest(
            spark.createDataFrame([old], schema), spark.createDataFrame([new], schema),
            ["company_number", "director_name"], U.filing_order())
        assert [tuple(r) for r in merged.collect()] == [("1", "X", None, "b", "Feb-21", t1)]


def test_latest_wins_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "Jan-21", 1), ("a", "Sep-20", 2), ("a", "Jan-21", 0)],
                               "k string, ch_upload string, f int")
    newest = D.latest_wins(df, ["k"], D.recency("ch_upload", "f"))
    assert [tuple(r) for r in newest.collect()] == [("a", "Jan-21", 1)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


@pytest.mark.parametrize("staged, previous, passed", [(0, 5, False), (94, 100, False), (95, 100, True), (10, 0, True)])
def test_snapshot_gate(spark, staged, previous, passed):
    assert Q.snapshot_gate(spark.range(staged), spark.range(previous)).first()["passed"] is passed


def test_known_files_are_skipped_by_month(spark):
    files = spark.createDataFrame([("f", "Jan-21"), ("f", "Feb-21"), ("g", "Jan-21")], "source_file string, ch_upload string")
    ledger = spark.createDataFrame([("f", "Jan-21", "failed")], "source_file string, ch_upload string, status string")
    found = lambda df: sorted(tuple(r) for r in df.collect())
    assert found(L.new_files(files, ledger)) == [("f", "Feb-21"), ("g", "Jan-21")]
    assert len(found(L.new_files(files, ledger, statuses=("success",)))) == 3
    assert found(L.new_files(files, ledger, ["source_file"])) == [("g", "Jan-21")]
    assert found(L.filter_heavy(files, L.new_files(files, ledger), months=["Jan-21", "Feb-21"])) == [("f", "Feb-21"), ("g", "Jan-21")]
    assert found(L.filter_heavy(files, files, months=[])) == []


def test_month_outcome_and_rate(spark):
    rows = [("a", "failed")] * 3 + [("b", "success")] + [("b", "failed")] * 3 + [("c", "warning")]
    ledger = spark.createDataFrame([(*r, datetime(2025, 1, 2)) for r in rows], "ch_upload string, status string, processed_at timestamp")
    got = L.with_rate(L.month_outcome(L.run_counts(ledger, datetime(2025, 1, 1)))).orderBy("ch_upload").collect()
    assert [(r.status, r.success_rate, r.files_warned) for r in got] == [
        ("failed", "0.00%", 0), ("completed", "25.00%", 0), ("completed", "N/A", 1)]
    assert L.run_counts(ledger, datetime(2025, 1, 3)).count() == 0


def test_verification_levels(spark):
    facts = spark.createDataFrame([("Jan-21", "1", "m", None)], "ch_upload string, company_number string, metric string, value double")
    named = spark.createDataFrame([("Feb-21", "1", "X")] * 2, "ch_upload string, company_number string, director_name string")
    told = spark.createDataFrame([], "ch_upload string, company_number string, section string")
    checks = Q.verify(facts, named, told)
    level = {(r.ch_upload, r.check_name): (r.value, r.level) for r in checks.collect()}
    assert level["Jan-21", "null_value"] == (1, "warning")
    assert level["Feb-21", "financial_rows"] == (0, "error")
    assert level["Feb-21", "duplicate_directors"] == (1, "warning")
    months = lambda *m: spark.createDataFrame([(x,) for x in m], "ch_upload string")
    assert Q.verdict(Q.verify(facts, named, told, months("Jan-21")))
    assert not Q.verdict(Q.verify(facts, named, told, months("Mar-21")))


LINES = [
    "STRATEGIC REPORT", "one two three four", "7.", "Page 3", "BALANCE SHEET", "lost",
    "RELATED PARTY TRANSACTIONS", "Loan to director", "12.", "dropped",
    "STRATEGIC REPORT (CONTINUED)", "more text"]


def sections_of(spark, *contents, **patterns):
    df = spark.createDataFrame(list(enumerate(contents)), "id int, html string")
    rows = S.section_rows(df, "html", "id", **patterns).collect()
    return [{r.section: r.text for r in rows if r.id == i} for i in range(len(contents))]


def test_sections(spark):
    body = "<p>" + "</p><p>\xa0".join(LINES) + "</p>"
    got = sections_of(
        spark, body, "<b>Directors’ report</b>0123456789", "<b>Directors' report</b>0123456789a",
        "controlling party\nnobody at all\n12.\ngone", "", None,
        "group strategic report for the year\nFor the year ended 2020\nREGISTERED NUMBER 1\n- 3 -\n44\nkept line only")
    assert got == [
        {"strategic_report": "one two three four\n7.\nmore text",
         "related_party_disclosures": "Loan to director"},
        {}, {"directors_report": "0123456789a"},
        {"ultimate_controlling_party": "nobody at all"}, {}, {},
        {"strategic_report": "kept line only"}]


@pytest.mark.parametrize("value, fmt, scale, sign, expected", [
    ("1,234.5", None, None, None, 1234.5), ("1 234", "ixt:numspacedot", 3, "-", -1234000.0),
    ("1.234,5", "ixt:numcommadecimal", None, None, 1234.5), ("-", None, None, None, 0.0),
    ("-", "ixt:zerodash", None, None, 0.0), ("", None, None, None, None), ("abc", None, 2, None, None),
    ("12", "ixt:nocontent", None, None, None), ("0", None, None, "-", 0.0), ("5", "ixt9:odd", None, None, None),
    ("NaN", None, None, None, None), ("Infinity", None, None, None, None), ("1d", None, None, None, None), ("2f", None, None, None, None), (".5", None, None, None, 0.5)])
def test_numbers(spark, value, fmt, scale, sign, expected):
    (got,) = one(spark, V.number(*[F.lit(x).cast(t) for x, t in (
        (value, "string"), (fmt, "string"), (scale, "int"), (sign, "string"))]))
    assert got == expected and str(got) == str(expected)


@pytest.mark.parametrize("value, fmt, expected", [
    (" plain ", None, "plain"), ("30 June 2025", "ixt:datedaymonthyearen", "2025-06-30"),
    ("1st Jan 21", "ixt2:datedaymonthyearen", "2021-01-01"), ("30.6.25", "ixt:datedaymonthyear", "2025-06-30"),
    ("06/30/2025", "ixt:datemonthdayyear", "2025-06-30"), ("2025-13-30", "ixt:dateyearmonthday", None),
    ("x", "ixt:fixed-true", "true"), ("May 1, 2020", "ixt2:datemonthdayyearen", None)])
def test_text_values(spark, value, fmt, expected):
    assert one(spark, V.text(F.lit(value), F.lit(fmt).cast("string"))) == (expected,)


def test_comments(spark):
    (text,) = one(spark, T.error_comment(F.lit("a.html"), F.lit("here"), F.lit(None), F.lit("e" * 3000)))
    assert text == "FILE: a.html\nhere\n\n" + "e" * 3000
    assert len(one(spark, T.comment(F.lit(text)))[0]) == 2000
    assert one(spark, T.flatten_controls(F.lit("a\tb\nc\r\\d")), T.blank_to_null(F.lit(" \xa0\t"))) == ("a b c\\d", None)


def test_batches_start_and_finish(spark):
    schema = "batch_id string, ch_upload string, source string, zip_filename string, started_at timestamp"
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 2, 1)
    start = lambda at, z: spark.createDataFrame([("b", "Jan-21", "s", z, at)], schema)
    from filigree.sources.schemas import MONTH_LEDGER
    ledger = L.start_batches(spark.createDataFrame([], MONTH_LEDGER), start(t1, "one"))
    done = spark.createDataFrame(
        [("b", "completed", 5, 1, t1), ("unknown", "failed", 0, 0, t1)],
        "batch_id string, status string, files_processed int, files_failed int, completed_at timestamp")
    ledger = L.finish_batches(ledger, done)
    (row,) = ledger.collect()
    assert (row.status, row.files_processed, row.completed_at) == ("completed", 5, t1)
    assert L.is_completed(ledger, "b") and not L.is_completed(ledger, "c")
    (again,) = L.start_batches(ledger, start(t2, "two")).collect()
    assert (again.status, again.files_processed, again.completed_at, again.zip_filename) == ("running", 5, None, "one")
    (again,) = L.start_batches(ledger, start(t2, "two"), relabel=True, clear_completed=False).collect()
    assert (again.completed_at, again.zip_filename, again.started_at) == (t1, "two", t2)
