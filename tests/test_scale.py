"""Against brute force, on generated documents and on skewed keys."""

import os
import random
import re
from datetime import datetime

from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import sections as S
from filigree.operators import ledger as L
from filigree.operators import quality as Q
from filigree.operators.running import running_last, sections_of_lines
from filigree.plans.verification import verified, verify_tables
from filigree.sources.schemas import register_tables
from tests.test_rules import sections_of


def brute_sections(content):
    flags = re.IGNORECASE
    found, open_section = {}, None
    for line in (x.strip() for x in re.sub(r"<[^>]+>", "\n", content).split("\n")):
        if not line:
            continue
        starts = [name for pattern, name in fv.SECTION_STARTS if re.match(pattern, line, flags)]
        if starts:
            open_section = starts[0]
        elif any(re.match(p, line, flags) for p in fv.SECTION_STOPS):
            open_section = None
        elif open_section in fv.NOTE_SECTIONS and re.match(fv.NOTE_NUMBER, line):
            open_section = None
        elif open_section and not any(re.match(p, line, flags) for p in fv.SECTION_SKIPS):
            found.setdefault(open_section, []).append(line)
    texts = {k: "\n".join(v) for k, v in found.items()}
    return {k: v for k, v in texts.items() if len(v) > 10}


def test_sections_equal_brute_force(spark):
    pieces = [
        "STRATEGIC REPORT", "Group strategic report", "Directors' Report", "REPORT OF THE DIRECTORS REPORT",
        "RELATED PARTY DISCLOSURES", "Ultimate controlling party", "Controlled party note",
        "Balance sheet", "NOTES TO THE accounts", "Company information", "7.", "12. ", "7", "Page 3", "- 4 -",
        "Registered number 12", "for the year ended 1", "some ordinary words", "a", "é\xa0ü", " \xa0 ", "x < y", ""]
    draw = random.Random(7)
    documents = ["".join(
        draw.choice(["<p>", "<br/>", "\n", "</div><div class='a'>"]) + draw.choice(pieces)
        for _ in range(draw.randrange(60))) for _ in range(150)]
    assert sections_of(spark, *documents) == [brute_sections(d) for d in documents]


def test_running_value_equals_brute_force_with_one_hot_document(spark):
    draw = random.Random(5)
    rows, expected = [], {}
    for doc, size in [("hot", 4000)] + [(f"d{i}", draw.randrange(30)) for i in range(40)]:
        seen = "none"
        for pos in range(size):
            name = draw.choice([None] * 30 + ["A", "B", "C"])
            seen = name or seen
            rows.append((doc, pos, name))
            expected[doc, pos] = seen
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc string, pos int, name string")
    for block_rows in (7, 100_000):
        got = running_last(df, ["doc"], "pos", F.col("name"), "seen", default="none", block_rows=block_rows)
        assert {(r.doc, r.pos): r.seen for r in got.collect()} == expected


def test_warnings_of_one_hot_file(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("f"), F.col("id").cast("string"))).alias("f"),
        F.col("id").alias("ord"), F.lit("ixt").alias("warning"))
    numbered = L.numbered_warnings(df, ["f"], "ord")
    assert sorted(r.n for r in numbered.where("f = 'hot'").collect()) == list(range(1, 2501))
    got = {r.f: r for r in L.warning_comments(numbered, ["f"], F.col("f")).collect()}
    whole = (
        "FILE: hot\nParsed with 2500 warning(s) — data SAVED (only flagged fields were skipped):\n"
        + "\n".join(f"  [{i + 1}] ixt" for i in range(2500)))
    assert got["hot"].comment == whole[:2000] and got["hot"].n_warnings == 2500
    assert len(got) == 501


def test_sections_of_lines_equal_those_of_whole_documents(spark):
    draw = random.Random(11)
    pieces = ["STRATEGIC REPORT", "RELATED PARTY DISCLOSURES", "Ultimate controlling party", "Balance sheet",
              "7.", "12. ", "Page 3", "some ordinary words", "more words that are kept", "a"]
    documents = [(k, "\n".join(draw.choice(pieces) for _ in range(draw.randrange(40)))) for k in range(80)]
    documents.append((99, "\n".join(["RELATED PARTY DISCLOSURES"] + ["a line of the note"] * 500 + ["7."] + ["lost"] * 500
                                    + ["STRATEGIC REPORT"] + ["kept all the way"] * 700)))
    df = spark.createDataFrame(documents, "doc long, content string")
    whole = sorted(map(tuple, S.section_rows(df, "content", "doc").collect()))
    assert any(len(t) > 5000 for _, _, t in whole)
    told = S.text_lines(df, "content", "doc")
    for block_rows in (3, 64, 100_000):
        got = sections_of_lines(
            told, ["doc"], "pos", "line", starts=fv.SECTION_STARTS, stops=fv.SECTION_STOPS, note_number=fv.NOTE_NUMBER,
            skips=fv.SECTION_SKIPS, note_sections=fv.NOTE_SECTIONS, min_chars=fv.MIN_SECTION_CHARS, block_rows=block_rows)
        assert sorted(map(tuple, got.collect())) == whole


def test_heavy_rows_are_filtered_where_they_are(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("f"), F.col("id").cast("string"))).alias("source_file"),
        F.when(F.col("id") % 5 > 0, F.lit("Jan-21")).alias("ch_upload"), F.repeat(F.lit("x"), 50).alias("content"), "id")
    for n, bits in ((0, 8), (40, 16), (40, 6), (500, 10), (3000, 27)):
        new = rows.where(f"id < {n}").select("source_file", "ch_upload")
        want = {r.id for r in rows.join(new.distinct().withColumnRenamed("source_file", "f").withColumnRenamed("ch_upload", "c"), [
            F.col("source_file").eqNullSafe(F.col("f")), F.col("ch_upload").eqNullSafe(F.col("c"))], "left_semi").collect()}
        got = L.filter_heavy(rows, new, work=f"{tmp_path}/{n}-{bits}", bits=bits)
        assert got.columns == rows.columns and {r.id for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(source_file" not in plan
    some = L.filter_heavy(rows, rows.select("source_file", "ch_upload"), months=["Jan-21"], work=f"{tmp_path}/m")
    assert some.where("ch_upload IS NULL").count() == 0 and some.count() == 2400
    assert L.filter_heavy(rows, rows, months=["Jan-21", None], work=f"{tmp_path}/n").count() == 3000


def test_verification_reads_only_what_is_new(spark, tmp_path):
    root = str(tmp_path)
    t = register_tables(root)
    schema = t["financials"].schema

    def facts(*rows):
        return spark.createDataFrame(
            [(c, m, v, "p", None, None, "no", "x", None, f, u, None) for c, m, v, f, u in rows], schema)

    def named(*rows):
        return spark.createDataFrame([(c, d, None, "f", u, datetime(2025, 1, 1)) for c, d, u in rows], t["directors"].schema)

    def check():
        got = {(r.ch_upload, r.check_name): (r.value, r.level) for r in verify_tables(spark, root).collect()}
        plain = Q.verify(*(t[n].read(spark) for n in ("financials", "directors", "reports")))
        assert got == {(r.ch_upload, r.check_name): (r.value, r.level) for r in plain.collect()}
        return got

    assert check() == {}
    t["financials"].append(facts(("1", "m", 1.0, "a", "Jan-21"), ("1", None, None, "a", "Jan-21"), (None, "m", 2.0, "b", "Jan-21")))
    t["directors"].append(named(("1", "x", "Jan-21"), ("2", "y", "Feb-21")))
    assert check()["Jan-21", "companies"] == (1, "ok")
    # what has been counted is not read again: it could be gone
    (first,) = t["financials"].store.state(spark).entries("financials")
    os.rename(f"{root}/{first['dir']}", f"{root}/elsewhere")
    t["financials"].append(facts(("2", "m", 1.0, "c", "Jan-21"), ("1", "m", 1.0, "c", "Feb-21")))
    got = {(r.ch_upload, r.check_name): r.value for r in verify_tables(spark, root).collect()}
    assert (got["Jan-21", "companies"], got["Jan-21", "financial_rows"], got["Feb-21", "companies"]) == (2, 4, 1)
    assert (got["Jan-21", "null_company_number"], got["Jan-21", "null_metric"], got["Jan-21", "null_value"]) == (1, 1, 1)
    os.rename(f"{root}/elsewhere", f"{root}/{first['dir']}")
    # a file is replaced, a director is found again, months are folded
    t["financials"].append(facts(("3", "m", 1.0, "a", "Jan-21")), replacing=facts(("", "", 0.0, "a", "Jan-21")).select("source_file", "ch_upload"))
    t["directors"].append(named(("1", "x", "Mar-21"), ("3", "z", "Mar-21")))
    assert check()["Jan-21", "financial_rows"] == (3, "ok")
    t["financials"].fold(spark, 1)
    t["directors"].fold(spark, 1)
    assert check()["Mar-21", "director_rows"] == (2, "ok")
    assert len({p for e in t["fact_checks"].store.state(spark).entries("fact_checks") for p in e["parts"]}) == 1
    assert not verified(spark, root, ["Apr-21"]) and verified(spark, root, ["Jan-21"])
