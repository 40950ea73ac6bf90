"""Tables that change by appending: what readers see, what is written, two writers."""

import os
import random
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from filigree.operators.upserts import filing_order
from filigree.plans import filings as J
from filigree.sources import tables as tables_
from filigree.sources.schemas import register_tables
from filigree.sources.tables import Merge, Store, Table
from tests.test_filings_load import filing, land, rows

T1, T2 = datetime(2025, 1, 1), datetime(2025, 2, 1)


def size(path) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if not f.startswith("."))


def seen(table, spark, *args) -> list:
    return sorted(map(tuple, table.read(spark, *args).collect()), key=str)


def test_rows_of_files_loaded_again_are_replaced(spark, tmp_path):
    table = Table(f"{tmp_path}/t", "f string, v int, m string", ("m",), ("f",))
    frame = lambda *r: spark.createDataFrame(list(r), "f string, v int, m string")
    table.append(frame(("a", 1, "x"), ("a", 2, "x"), ("b", 3, "x"), ("a", 4, "y"), (None, 5, None)))
    table.append(frame(("c", 6, "x")))
    again = frame(("a", 7, "x"), (None, 8, None))
    table.append(again, replacing=again.select("f", "m"))
    want = [("a", 4, "y"), ("a", 7, "x"), ("b", 3, "x"), ("c", 6, "x"), (None, 8, None)]
    assert seen(table, spark) == sorted(want, key=str)
    assert seen(table, spark, ["x"]) == [r for r in sorted(want, key=str) if r[2] == "x"]
    # twice more; rows of the file in between must not come back
    table.append(frame(("a", 9, "x")).limit(0), replacing=frame(("a", 0, "x")).select("f", "m"))
    table.append(frame(("a", 10, "x")))
    want = [r if r[1] != 7 else ("a", 10, "x") for r in want]
    assert seen(table, spark) == sorted(want, key=str)
    assert table.fold(spark, 3) == 2  # months x and NULL; y stays where it is
    assert seen(table, spark) == sorted(want, key=str)
    assert {p for e in table.store.state(spark).entries("t") if e["kind"] == "parts" for p in e["parts"]} == {
        "m=x", "m=__HIVE_DEFAULT_PARTITION__"}
    assert table.compact(spark) >= 2 and seen(table, spark) == sorted(want, key=str)
    assert len(table.store.state(spark).entries("t")) == 1
    assert table.drop_superseded(spark) > 0 and seen(table, spark) == sorted(want, key=str)
    assert len(os.listdir(tmp_path / "t")) == 1


def test_a_table_without_partitions(spark, tmp_path):
    table = Table(f"{tmp_path}/t", "f string, v int")
    frame = lambda *r: spark.createDataFrame(list(r), "f string, v int")
    assert seen(table, spark) == []
    table.append(frame(("a", 1), ("b", 2)))
    table.append(frame(("a", 3)), replacing=frame(("a", 0)).select("f"))
    assert seen(table, spark) == [("a", 3), ("b", 2)]
    table.update(spark, lambda old: old.where("v < 3"))
    assert seen(table, spark) == [("b", 2)]


def merged_table(tmp_path, spark):
    table = Table(f"{tmp_path}/t", "k string, v string, filing_date date, source_file string, ch_upload string, loaded_at timestamp",
                  ("ch_upload",), ("k",), Merge(("k",), filing_order, buckets=4))

    def frame(rows):
        return spark.createDataFrame(
            [(k, v, None, f, m, t) for k, v, f, m, t in rows],
            "k string, v string, filing_date date, source_file string, ch_upload string, loaded_at timestamp")
    return table, frame


def test_changes_by_key_against_brute_force(spark, tmp_path):
    table, frame = merged_table(tmp_path, spark)
    r, best, first = random.Random(4), {}, {}
    for step in range(7):
        at = datetime(2025, 1, step + 1)
        new = {k: (k, f"v{step}", f"f{r.randrange(20):02}", f"{r.choice(('Jan', 'Feb', 'Mar'))}-21", at)
               for k in {r.choice([None, *"abcdefghij"]) for _ in range(4)}}
        order = lambda x: (("Jan-21", "Feb-21", "Mar-21").index(x[3]), x[2], x[4])
        for k, row in new.items():
            first.setdefault(k, at)
            best[k] = max(best.get(k, row), row, key=order)
        entry = table.stage(frame(list(new.values())), "add" if step else "full")
        table.store.commit(spark, lambda _, e=entry: {"t": [e]})
        if step == 4:
            assert table.fold(spark, 3) > 0
        want = sorted((k, x[1], x[2], x[3], first[k]) for k, x in best.items() if k) + [
            (None, x[1], x[2], x[3], first[k]) for k, x in best.items() if k is None]
        got = table.read(spark).select("k", "v", "source_file", "ch_upload", "loaded_at")
        assert sorted(map(tuple, got.collect()), key=lambda x: (x[0] is None, x)) == want
        assert got.columns and "_bucket" not in table.read(spark).columns
    jan = table.read(spark, ["Jan-21"]).collect()
    assert {x.k for x in jan} == {k for k, x in best.items() if x[3] == "Jan-21"}


def test_only_changed_keys_are_brought_together(spark, tmp_path):
    table, frame = merged_table(tmp_path, spark)
    table.write(frame([(f"k{i}", "v", "f", "Jan-21", T1) for i in range(100)]))
    table.append(frame([("k1", "w", "f", "Feb-21", T2)]))
    plan = table.read(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_one_percent_new_files_write_about_one_percent(spark, tmp_path):
    table = Table(f"{tmp_path}/t", "f long, v string, m string", ("m",))
    frame = lambda a, b: spark.range(a, b).select(
        F.col("id").alias("f"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("Jan-21").alias("m"))
    table.append(frame(0, 50_000))
    before = size(tmp_path / "t")
    new = frame(50_000, 50_500)
    table.append(new, replacing=new.select("f", "m"))
    assert size(tmp_path / "t") - before < 0.03 * before
    assert table.read(spark).count() == 50_500


def test_two_writers_lose_nothing(spark, tmp_path):
    table = Table(f"{tmp_path}/t", "f string, v int, m string", ("m",))
    frame = lambda *r: spark.createDataFrame(list(r), "f string, v int, m string")
    made, tries = table.stage(frame(("b", 2, "x"))), []

    def change(state):
        if not tries:  # the other writer comes in between
            table.append(frame(("a", 1, "x")))
        tries.append(state.number)
        return {"t": [made]}

    table.store.commit(spark, change)
    assert tries == [0, 1] and seen(table, spark) == [("a", 1, "x"), ("b", 2, "x")]

    counter = Table(f"{tmp_path}/n", "n long")
    counter.write(spark.range(1).toDF("n"))
    errors = []

    def count():
        try:
            for _ in range(3):
                counter.update(spark, lambda old: old.select(F.col("n") + 1).toDF("n"))
        except Exception as e:  # pragma: no cover
            errors.append(e)

    threads = [threading.Thread(target=count) for _ in range(3)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert not errors and counter.read(spark).first().n == 9


def test_two_loads_of_the_same_files_at_once(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    for i in range(3):
        land(landing, "2021-01", f"Prod224_0086_0000000{i}_20200229.html", filing(turnover=str(i)))
    whole, inner = J._commit_in, []

    def first(*args):
        if not inner:  # found the same files new, and is done before this one
            inner.append(1)
            land(landing, "2021-01", "Prod224_0086_00000009_20200229.html", filing(turnover="9"))
            J.filings_load(spark, str(landing), root, at=T1)
        return whole(*args)

    monkeypatch.setattr(J, "_commit_in", first)
    J.filings_load(spark, str(landing), root, at=T2)
    t = register_tables(root)
    assert sorted(r.value for r in t["financials"].read(spark).collect()) == [-9000.0, -2000.0, -1000.0, 0.0]
    assert t["file_ledger"].read(spark).count() == 4 and t["fields"].read(spark).count() == 8
    assert len(rows(t["directors"], spark, "company_number")) == 4


def test_a_reader_sees_all_tables_of_a_load_or_none(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    for i in range(2):
        land(landing, "2021-01", f"Prod224_0086_0000000{i}_20200229.html", filing(turnover=str(i)))
    t, seen_at = register_tables(root), []
    names = ("financials", "fields", "directors", "reports", "file_ledger")

    def look(*_):
        state = Store(root).state(spark)
        seen_at.append(tuple(t[n].read(spark, state=state).count() for n in names))

    stage, claim = Table.stage, tables_._claim
    monkeypatch.setattr(Table, "stage", lambda self, *a, **k: (stage(self, *a, **k), look())[0])
    monkeypatch.setattr(tables_, "_claim", lambda *a: (look(), claim(*a), look())[1])
    J.filings_load(spark, str(landing), root, at=T1)
    done = tuple(t[n].read(spark).count() for n in names)
    assert done == (2, 4, 2, 2, 2) and len(seen_at) > 10
    assert set(seen_at) == {(0,) * 5, done}


def test_a_commit_cut_off_is_passed_over(spark, tmp_path, monkeypatch):
    table = Table(f"{tmp_path}/t", "n long")
    table.write(spark.range(1).toDF("n"))
    path = tmp_path / "_commits" / "00000002.json"
    path.write_text('{"base": 1, "tab')
    assert table.read(spark).count() == 1
    os.utime(path, (1, 1))  # long ago
    table.write(spark.range(3).toDF("n"))
    assert table.read(spark).count() == 3 and Store(str(tmp_path)).state(spark).number == 3

    # the slow writer ends its file after all: it finds that it was passed over, and goes on
    number, claim = [], tables_._claim

    def slow(spark_, path_, text):
        made = claim(spark_, path_, text)
        if not number:
            number.append(4)
            (tmp_path / "_commits" / "00000005.json").write_text(
                '{"base": 3, "tables": {"t": %s}}' % str(table.store.state(spark).tables["t"]).replace("'", '"'))
        return made

    monkeypatch.setattr(tables_, "_claim", slow)
    entry = table.stage(spark.range(5).toDF("n"), "full")
    state = table.store.commit(spark, lambda _: {"t": [entry]})
    assert state.number == 6 and table.read(spark).count() == 5


def test_a_store_that_is_not_local_is_claimed_by_create(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.tables.link./in", f"file://{tmp_path}")
    path = "viewfs://tables/in/_commits/00000001.json"
    assert tables_._claim(spark, path, '{"tables": {}}') and not tables_._claim(spark, path, "[]")
    assert tables_._text(spark, path) == '{"tables": {}}'
    table = Table("viewfs://tables/in/t", "n long")
    assert table.store.state(spark).tables == {}
    os.remove(tmp_path / "_commits" / "00000001.json")
    table.append(spark.range(2).toDF("n"))
    table.append(spark.range(2).toDF("n"))
    assert table.read(spark).count() == 4


def test_clean_leaves_what_it_does_not_know(spark, tmp_path):
    table = Table(f"{tmp_path}/t", "n long")
    table.write(spark.range(1).toDF("n"))
    own = tmp_path / "t" / ("0" * 32)
    os.makedirs(own), os.makedirs(tmp_path / "t" / "notes"), os.makedirs(tmp_path / "landing" / ("1" * 32))
    for p in (own, tmp_path / "t" / "notes", tmp_path / "landing" / ("1" * 32)):
        os.utime(p, (1, 1))
    table.store.clean(spark, 1)
    assert not own.exists() and (tmp_path / "t" / "notes").exists() and (tmp_path / "landing" / ("1" * 32)).exists()


def test_a_month_label_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        Table(f"{tmp_path}/t", "n long, m string", ("m",)).write(spark.range(1).selectExpr("id n", "'x' m"), ["../x"])


def test_wide_rows_are_dealt_by_bytes_in_memory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_, "TASK_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(tables_, "MANY_KEYS", 0, raising=False)
    held = register_tables(str(tmp_path))["quarantine"]
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("source_file"), F.lit("p").alias("path"), F.lit(None).cast("string").alias("content"),
        F.repeat(F.lit("ab"), F.lit(2000)).alias("comment"), F.lit(0).alias("attempts"),
        F.when(F.col("id") % 100 > 0, "Jan-21").otherwise(F.when(F.col("id") % 200 > 0, "Feb-21")).alias("ch_upload"),
        F.lit("failed").alias("status"))
    want = sorted(map(tuple, df.collect()), key=str)
    for k in range(2):  # 12 MB that compress to next to nothing
        held.append(df, replacing=df.select("source_file", "ch_upload"))
        assert seen(held, spark) == want
        newest = held.store.state(spark).entries("quarantine")[-1]
        parts = [f for _, _, fs in os.walk(f"{tmp_path}/{newest['dir']}") for f in fs if f.startswith("part-")]
        assert 12 <= len(parts) <= 16
    again = df.where("cast(source_file AS int) % 2 = 0")
    held.append(again, replacing=again.select("source_file", "ch_upload"))
    plan = held.read(spark)._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan  # the wide rows are not sorted
    assert seen(held, spark) == want
    held.append(df.limit(0))
    assert seen(held, spark) == want


def test_the_order_of_an_upsert_is_worked_out_once_per_row(spark):
    schema = "k string, v int, ch_upload string, filing_date date, source_file string, loaded_at timestamp"
    df = spark.createDataFrame([("a", 1, "Jan-21", None, "f", T1), ("a", 2, "Feb-21", None, "e", T2), (None, 3, None, None, None, T1)], schema)
    got = tables_.upsert_latest(df.limit(0), df, ["k"], filing_order())
    assert {(r.k, r.v, r.loaded_at) for r in got.collect()} == {("a", 2, T1), (None, 3, T1)}
    lines = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("max_by" in x and "Feb" in x for x in lines)  # the months' names
