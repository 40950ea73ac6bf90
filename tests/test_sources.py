"""CSV and filing sources, versioned tables, and the snapshot job."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from filigree.plans.snapshot import SnapshotRejected, snapshot_load
from filigree.sources import filings as FI
from filigree.sources import ixbrl
from filigree.sources.schemas import register_tables
from filigree.sources.snapshot_csv import ends_inside, file_profiles, normalise_rows, read_snapshot
from filigree.sources.tables import Table


def test_snapshot_files_of_both_encodings_and_shapes(spark, tmp_path):
    header = " CompanyNumber,CompanyName,RegAddress.PostTown"
    (tmp_path / "a.csv").write_bytes(
        b"\xef\xbb\xbf" + f'{header}\n1,"A ""q"", Ltd",York\n2,short\n3,long,Hull,extra\n\n'.encode())
    (tmp_path / "b.CSV").write_bytes(f"{header}\n4,".encode() + b"caf\xe9 \x80 \x81,Bath\n")
    (tmp_path / "c.csv").write_bytes(
        '"CompanyName"," CompanyNumber","Other"\n"two\nlines €",5,x\n"   ",6,y\n'.encode())
    (tmp_path / "d.txt").write_text("not read")
    profiles = {os.path.basename(p.file_path): (p.utf8, p.splittable)
                for p in file_profiles(spark, str(tmp_path)).collect()}
    assert profiles == {"a.csv": (True, True), "b.CSV": (False, True), "c.csv": (True, False)}
    rows = normalise_rows(read_snapshot(spark, str(tmp_path)), None, "file_name")
    got = sorted((r.company_number, r.company_name, r.post_town, r.county, r.file_name) for r in rows.collect())
    assert got == [
        ("1", 'A "q", Ltd', "York", None, "a.csv"), ("2", "short", None, None, "a.csv"),
        ("3", "long", "Hull", None, "a.csv"), ("4", "café € �", "Bath", None, "b.CSV"),
        ("5", "two lines €", None, None, "c.csv"), ("6", None, None, None, "c.csv")]
    assert len(rows.columns) == 27


def test_line_states():
    for line, inside, ends in (
            ("a,b", False, False), ("a,b", True, True), ('a,"b', False, True), ('b",c', True, False),
            ('a,"b ""c"" d",e', False, False), ('a,"b ""', False, True), ('x ""', True, True), ('x"""', True, False),
            ('5" pipe,u', False, False), ('5" pipe,"u', False, True), ('"a"tail,"b', False, True), ('""', False, False),
            ('"', False, True), ('"', True, False), ('","', True, True), ("", True, True), ('"a""', False, True)):
        assert ends_inside(line, inside) == ends, line


def break_rows(r, n):
    out = []
    for k in range(n):
        name = r.choice(["plain", 'say "hi"', "two\nlines", "three\n\nlines €", 'edge"\n"', "a,b\r\nc", "", '5" pipe', "x" * 300])
        out.append((str(k), name, r.choice(["York", "\n", "Hull €", '"'])))
    return out


@pytest.mark.parametrize("encoding", ["utf-8", "cp1252"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_inside_fields_are_read_by_many_tasks(spark, tmp_path, encoding, end):
    import csv
    import random

    r, want = random.Random(end + encoding), []
    for f in range(2):
        rows = break_rows(r, 400) + [("long", "line\n" * 900, "spans splits")] + [(f"q{i}", "q", "q") for i in range(50)]
        # where lines end in CRLF, fields break by line feeds
        want += [(f"{f}.csv", a, b.replace(end, "\n"), c) for a, b, c in rows]
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding=encoding) as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerow([" CompanyNumber", "CompanyName", "RegAddress.PostTown"])
            for k, row in enumerate(rows):
                writer.writerow(row)
                if k % 50 == 0:
                    out.write(end)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700")
    try:
        read = read_snapshot(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 20
        got = sorted((x.file_name, x[0], x[1] or "", x[2]) for x in read.collect())
    finally:
        spark.conf.set(key, before)
    assert got == sorted(want)
    # as the parser that reads a file whole
    plain = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option(
        "encoding", "UTF-8" if encoding == "utf-8" else "ISO-8859-1").csv(str(tmp_path))
    if encoding == "utf-8":
        assert sorted((x[0], x[1] or "", x[2]) for x in plain.collect()) == sorted(w[1:] for w in want)


def test_one_quoted_break_in_a_large_file(spark, tmp_path):
    lines = [f'{k},name {k},"York"' for k in range(20_000)]
    lines[7] = '7,"name\n7","York"'
    (tmp_path / "a.csv").write_text("\n".join([" CompanyNumber,CompanyName,RegAddress.PostTown", *lines]) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        read = read_snapshot(spark, str(tmp_path))
        spread = read.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(spread) > 4 and sum(p["count"] for p in spread) == 20_000
        assert read.where("CompanyName = 'name\n7'").count() == 1
    finally:
        spark.conf.set(key, before)


def test_returns_alone_are_read_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b' CompanyNumber,CompanyName\r1,"a\rb"\r2,c\r')
    got = normalise_rows(read_snapshot(spark, str(tmp_path))).collect()
    assert sorted((x.company_number, x.company_name) for x in got) == [("1", "a b"), ("2", "c")]


def test_missing_snapshot(spark, tmp_path):
    with pytest.raises(ValueError, match="no CSV"):
        read_snapshot(spark, str(tmp_path))


def test_filing_scan(spark, tmp_path):
    for name, data in (("2021-01/x/y/a.html", b"ok \xff\xc3\xa9\xef\xbf\xbd\xc3"), ("2021-02/b.xhtml", b"two"),
                       ("2021-02/c.xml", b"three"), ("2021-02/d.txt", b"no")):
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = sorted((r.source_file, r.ch_upload, r.content) for r in FI.scan_filings(spark, str(tmp_path)).collect())
    assert got[:2] == [("a", "Jan-21", "ok é\ufffd"), ("b", "Feb-21", "two")]
    assert [g[0] for g in got] == ["a", "b", "c"]
    assert sorted(r.source_file for r in FI.list_filings(spark, str(tmp_path), ["2021-02", "2021-09"]).collect()) == ["b", "c"]
    assert FI.scan_filings(spark, str(tmp_path), ["2021-09"]).count() == 0


def test_nested_folders_are_listed_level_by_level(spark, tmp_path):
    want = set()
    for k in range(60):
        deep = "/".join(["2021-01", *[f"d{k % 3}", f"e{k % 7}", f"f{k}"][:k % 4]])
        os.makedirs(tmp_path / deep, exist_ok=True)
        (tmp_path / deep / f"n{k}.html").write_text("x" * k)
        want.add((f"n{k}", k))
    for hidden in ("2021-01/_tmp", "2021-01/d0/.x"):
        os.makedirs(tmp_path / hidden)
        (tmp_path / hidden / "h.html").write_text("h")
    os.makedirs(tmp_path / "2021-02" / "empty")
    work = tmp_path / "work"
    listed = FI.list_filings(spark, str(tmp_path), work=str(work))
    assert {(r.source_file, r.size) for r in listed.collect()} == want
    assert {r.ch_upload for r in listed.collect()} == {"Jan-21"}
    assert sorted(os.listdir(work)) == ["level-0", "level-1", "level-2", "level-3"]
    # as many tasks as folders: the 60 of the last level are not one task's
    assert len([f for f in os.listdir(work / "level-3") if f.startswith("part")]) > 3


def test_tasks_of_even_bytes(spark):
    import random

    r = random.Random(3)
    sizes = [r.choice((10, 1000, 200_000, 5_000_000)) for _ in range(3000)]
    listed = spark.createDataFrame([(f"p{k}", s) for k, s in enumerate(sizes)], "path string, size bigint")
    rows, tasks = FI.even_tasks(listed, task_bytes=100_000_000)
    load = {x.task: x.b for x in rows.groupBy("task").agg(F.sum(F.col("size") + FI.OPEN_BYTES).alias("b")).collect()}
    mean = sum(load.values()) / tasks
    assert len(load) == tasks > 30 and max(load.values()) < 2 * mean and sum(load.values()) == sum(sizes) + 3000 * FI.OPEN_BYTES
    one, n = FI.even_tasks(spark.createDataFrame([("a", None), ("b", 0)], "path string, size bigint"))
    assert n == 2 and one.count() == 2
    assert FI.even_tasks(listed.limit(0))[0].count() == 0


def test_table_versions(spark, tmp_path):
    table = Table(str(tmp_path / "t"), "k int, v string, m string", ("m",), ("k",))
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, m string")
    read = lambda *a: sorted(tuple(r) for r in table.read(spark, *a).collect())
    assert read() == []
    table.write(rows((1, "a", "Jan-21"), (2, "b", "Feb-21")))
    table.write(rows((3, "c", "Feb-21")), ["Feb-21"])
    assert read() == [(1, "a", "Jan-21"), (3, "c", "Feb-21")]
    assert read(["Feb-21"]) == [(3, "c", "Feb-21")]
    assert read(["Mar-21"]) == []
    # a month that ends up empty must not fall back to older content
    table.write(rows((9, "z", "Jan-21")).limit(0), ["Jan-21"])
    assert read() == [(3, "c", "Feb-21")]
    # a write that never committed is not seen
    table.stage(rows((5, "e", "Jan-21")))
    assert read() == [(3, "c", "Feb-21")]
    table.write(rows((4, "d", "Feb-21")))
    assert read() == [(4, "d", "Feb-21")]
    assert table.compact(spark) == 1
    assert read() == [(4, "d", "Feb-21")]
    with pytest.raises(ValueError):
        table.write(rows((4, "d", "Feb-21")), ["a/b"])


def snapshot(folder, *companies):
    os.makedirs(folder, exist_ok=True)
    lines = [" CompanyNumber,CompanyName"] + [f"{n},{name}" for n, name in companies]
    (folder / "data.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_snapshot_job(spark, tmp_path):
    root, t1, t2 = str(tmp_path / "root"), datetime(2025, 1, 1), datetime(2025, 2, 1)
    tables = register_tables(root)
    first = snapshot(tmp_path / "s1", *[(i, "a") for i in range(20)])
    assert snapshot_load(spark, first, root, date(2025, 1, 1), at=t1) == "completed"
    assert snapshot_load(spark, first, root, date(2025, 1, 1), at=t2) == "skipped"

    short = snapshot(tmp_path / "s2", *[(i, "b") for i in range(18)])
    with pytest.raises(SnapshotRejected, match="18 of 20"):
        snapshot_load(spark, short, root, date(2025, 2, 1), at=t2)
    twice = snapshot(tmp_path / "s3", *[(i % 19, "b") for i in range(20)])
    with pytest.raises(SnapshotRejected, match="more than once"):
        snapshot_load(spark, twice, root, date(2025, 2, 1), at=t2)
    assert {r.company_name for r in tables["companies"].read(spark).collect()} == {"a"}

    good = snapshot(tmp_path / "s4", *[(i, "b") for i in range(1, 20)])
    assert snapshot_load(spark, good, root, date(2025, 2, 1), at=t2) == "completed"
    kept = {r.company_number: (r.company_name, r.loaded_at) for r in tables["companies"].read(spark).collect()}
    assert len(kept) == 20 and kept["0"] == ("a", t1) and kept["19"] == ("b", t2)
    assert tables["staging"].read(spark).count() == 0
    months = {r.batch_id: r for r in tables["month_ledger"].read(spark).collect()}
    assert months["company_data_2025-02-01"].status == "completed"
    assert months["company_data_2025-02-01"].ch_upload == "February-2025"


def test_documents_other_than_inline_html():
    plain = """<xbrl xmlns:u="x"><context id="a"><period><instant>2020-01-31T00:00:00</instant></period></context>
    <u:Debtors contextRef="a" unitRef="GBP" decimals="0">12</u:Debtors><u:AccountsType contextRef="a">Full</u:AccountsType></xbrl>"""
    (numeric, text), odd = ixbrl.read_elements(plain)
    assert (numeric["kind"], numeric["name"], numeric["text"], numeric["instant"]) == ("numeric", "u:Debtors", "12", "2020-01-31")
    assert (text["kind"], text["text"], odd) == ("nonnumeric", "Full", [])
    loose = "<html><body><p>x<br>&nbsp;<ix:nonFraction name=u:Debtors contextRef=a xsi:nil=true></ix:nonFraction><p>"
    (nil,), _ = ixbrl.read_elements(loose)
    assert nil["text"] is None and nil["name"] == "u:Debtors"
    with pytest.raises(ValueError):
        ixbrl.read_elements("words only")


def test_batches_of_filings_are_bounded_by_rows_and_bytes(spark):
    from filigree.session import small_batches

    def rows_of(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for chars, most, batches in ((100, 256, 3), (1_000_000, 10, 60)):  # 16 rows each would be 38
        df = spark.range(600 if chars == 100 else 300).repartition(1).select(F.repeat(F.lit("x"), F.lit(chars)).alias("t"))
        with small_batches(spark):
            got = [r.n for r in df.mapInArrow(rows_of, "n bigint").collect()]
        assert max(got) <= most and len(got) <= batches
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_short_names_kept_between_documents_change_nothing():
    short = ixbrl._Names()
    odd = "".join(f"<n{k}:tag a{k}:x='1'>t</n{k}:tag>" for k in range(12_000))
    pages = ["<html><a:exclude/><nonFraction name='u:A' xsi:nil='true' contextRef='c'>1</nonFraction></html>",
             "<html><nonNumeric name='u:B'>x<b:exclude>y</b:exclude></a:exclude>z</nonNumeric>", f"<html>{odd}</html>",
             "<html><nonFraction NAME='u:A' i:nil='true' Scale='2'>1</nonFraction></html>"] * 2
    for page in pages:
        assert ixbrl.read_elements(page, short) == ixbrl.read_elements(page)
    assert len(short) <= 10_001
