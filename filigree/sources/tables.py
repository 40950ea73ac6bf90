"""Parquet tables below one root that change together, by appending.

A write makes a new data directory and nothing else. A commit is one small file,
``_commits/NNNNNNNN.json``, made exclusively: it names the directories that each table
below the root consists of, so readers see all of a commit or nothing of it, however
many tables it changes. Two writers that claim the same number can't both get it: the
second looks at what the first changed, adjusts its own change and claims the next.

A table is a list of entries, oldest first:

- ``full``: all rows anew; hides what stands before it.
- ``parts``: all rows of some partitions (months, buckets) anew; hides these partitions.
- ``add``: more rows. In a table with a ``merge`` rule they replace earlier rows of their
  key when the table is read; in others they simply add.
- ``gone``: keys whose earlier rows no longer count.

So a load of a few files writes a few rows, whatever the table holds. ``fold`` rewrites
those partitions that have gathered many entries.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as types_

from filigree.operators.upserts import upsert_latest

_COMMIT = re.compile(r"^(\d{8})\.json$")
_DATA = re.compile(r"^[0-9a-f]{32}$")
_LABEL = re.compile(r"^[A-Za-z0-9-]+$")
COMMITS, BUCKET = "_commits", "_bucket"
#: Tries of a commit that others come before; seconds that a commit file may be cut off
#: before it counts as lost with its writer.
TRIES, LOST_AFTER = 100, 60.0
#: Entries of a partition from which ``fold`` rewrites it.
FOLD_FROM = 16
#: Bytes in memory that a task of a wide table writes, and the tasks up to which that
#: holds: up to 200, Spark's shuffle writes rows straight to files, holding none. Beyond,
#: a task writes up to ``MOST_BYTES`` first.
TASK_BYTES, DIRECT_TASKS, MOST_BYTES = 128 << 20, 200, 1 << 30
#: Bytes of stored keys from which reading builds tables of the keys alone instead of
#: sorting the rows as well; fewer may be broadcast.
MANY_KEYS = 8 << 20


def _schema(ddl: str) -> types_.StructType:
    return types_.StructType.fromDDL(ddl)


# ---- files, through Hadoop so any store works ---------------------------------------

def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _listed(spark: SparkSession, path: str) -> list:
    fs, hadoop_path = _fs(spark, path)
    target = hadoop_path(path)
    return list(fs.listStatus(target)) if fs.exists(target) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path(path), True)


def _claim(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that nobody else has made; False if it is there. A local file
    appears with all its text at once; other stores make it exclusively."""
    fs, hadoop_path = _fs(spark, path)
    target = hadoop_path(path)
    if fs.getUri().getScheme() == "file":
        local = urlparse(target.toUri().toString()).path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        out = fs.create(target, False)
    except Exception:
        if fs.exists(target):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def _text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# ---- commits ------------------------------------------------------------------------

@dataclass(frozen=True)
class State:
    """What all tables consist of at one commit."""
    number: int = 0
    tables: Mapping[str, list] = field(default_factory=dict)

    def entries(self, name: str) -> list[dict]:
        return list(self.tables.get(name, ()))

    def with_entries(self, added: Mapping[str, list]) -> dict[str, list]:
        """Tables after a change, without entries that no longer show anything."""
        return {**self.tables, **{n: _live([*self.entries(n), *e]) for n, e in added.items()}}


def _live(entries: list[dict]) -> list[dict]:
    """Entries with the partitions that later ones leave them; none without any. The one
    partition of a table that has none is ''."""
    out, hidden, all_hidden = [], set(), False
    for e in reversed(entries):
        if all_hidden:
            break
        parts = {p: size for p, size in e["parts"].items() if p not in hidden}
        if parts:
            out.append({**e, "parts": parts})
        if e["kind"] == "parts":
            hidden.update(e["covers"])
        all_hidden = e["kind"] == "full"
    out = out[::-1]
    # keys are of use only while an earlier entry shows rows in their partitions
    shown: set = set()
    kept = []
    for e in out:
        if e["kind"] == "gone" and not shown & set(e["parts"]):
            continue
        if e["kind"] != "gone":
            shown.update(e["parts"])
        kept.append(e)
    return kept


@dataclass(frozen=True)
class Store:
    """The tables below one root."""
    root: str

    def _numbers(self, spark) -> list[tuple[int, float]]:
        found = [(_COMMIT.match(s.getPath().getName()), s.getModificationTime() / 1000)
                 for s in _listed(spark, f"{self.root}/{COMMITS}")]
        return sorted((int(m[1]), t) for m, t in found if m)

    def _path(self, number: int) -> str:
        return f"{self.root}/{COMMITS}/{number:08d}.json"

    def _commit(self, spark, number: int) -> dict | None:
        try:
            return json.loads(_text(spark, self._path(number)))
        except ValueError:  # not written to its end
            return None

    def _newest(self, spark) -> tuple[State, int, float]:
        """The newest whole commit, the highest number claimed, and when."""
        numbers = self._numbers(spark)
        for number, _ in reversed(numbers):
            found = self._commit(spark, number)
            if found:
                return State(number, found["tables"]), *numbers[-1]
        return State(), *(numbers[-1] if numbers else (0, 0.0))

    def state(self, spark: SparkSession) -> State:
        return self._newest(spark)[0]

    def commit(self, spark: SparkSession, change: Callable[[State], Mapping[str, list]]) -> State:
        """Add entries to tables. ``change`` gets the newest state and returns them by
        table; it is called again if another writer was first, and then sees what that
        one did. Directories that end up in no table are deleted."""
        offered: set[str] = set()
        for attempt in range(TRIES):
            state, highest, since = self._newest(spark)
            if highest > state.number and time.time() - since < LOST_AFTER:
                time.sleep(min(0.05 * (attempt + 1), 1))  # somebody is writing it just now
                continue
            added = change(state)
            if not added:
                return state
            offered.update(e["dir"] for es in added.values() for e in es)
            tables, mine = state.with_entries(added), highest + 1
            if not _claim(spark, self._path(mine), json.dumps({"base": state.number, "tables": tables})):
                continue
            # one that was thought lost in the middle: did another pass over it?
            if all((self._commit(spark, n) or {"base": mine})["base"] >= mine
                   for n, _ in self._numbers(spark) if n > mine):
                for path in offered - {e["dir"] for es in tables.values() for e in es}:
                    _delete(spark, f"{self.root}/{path}")
                return State(mine, tables)
        raise RuntimeError(f"no commit below {self.root} in {TRIES} tries")

    def clean(self, spark: SparkSession, keep: int = 2, orphans_after_days: float = 7) -> int:
        """Delete commits but the newest ``keep`` and all directories that only they
        name; also data directories of the tables that no commit names and that have not
        changed for some days, which lost runs leave. Returns how many went."""
        numbers = [n for n, _ in self._numbers(spark)]
        named = lambda ns: {e["dir"] for n in ns for es in (self._commit(spark, n) or {"tables": {}})["tables"].values()
                            for e in es}
        old, new = numbers[:-keep], numbers[-keep:]
        kept = named(new)
        gone = named(old) - kept
        limit = time.time() - orphans_after_days * 86400
        for name in {n for c in new for n in (self._commit(spark, c) or {"tables": {}})["tables"]}:
            for d in _listed(spark, f"{self.root}/{name}"):
                path = f"{name}/{d.getPath().getName()}"
                if _DATA.match(d.getPath().getName()) and path not in kept and d.getModificationTime() / 1000 < limit:
                    gone.add(path)
        for path in sorted(gone):
            _delete(spark, f"{self.root}/{path}")
        for n in old:
            _delete(spark, self._path(n))
        return len(gone)


# ---- tables ---------------------------------------------------------------------------

def dealt_by_bytes(rows: DataFrame, layout: Sequence[str]) -> DataFrame:
    """``rows`` in tasks of even bytes, partition after partition. Bytes are those in
    memory: shuffled ones, which Spark's rebalancing goes by, may be a hundredth of them
    where texts repeat themselves. The driver sees one row per partition."""
    spark, layout = rows.sparkSession, list(layout)
    width = reduce(Column.__add__, [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint") for f in rows.schema
                                    if isinstance(f.dataType, types_.StringType)], F.lit(16 * len(rows.columns)))
    sizes = sorted(rows.groupBy(*layout).agg(F.sum(width).alias("_bytes")).collect(),
                   key=lambda r: [(r[c] is not None, r[c]) for c in layout])
    total, begun, places = sum(r["_bytes"] for r in sizes), 0, []
    for r in sizes:
        places.append((*[r[c] for c in layout], float(begun), float(r["_bytes"])))
        begun += r["_bytes"]
    tasks = max(min(total // TASK_BYTES + 1, DIRECT_TASKS), total // MOST_BYTES)
    at = F.broadcast(spark.createDataFrame(places, types_.StructType(
        [types_.StructField(f"_at_{c}", rows.schema[c].dataType) for c in layout]
        + [types_.StructField(c, types_.DoubleType()) for c in ("_begun", "_bytes")])))
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)) / (1 << 20)
    task = F.floor((F.col("_begun") + share * F.col("_bytes")) * tasks / max(total, 1))
    return rows.join(at, [rows[c].eqNullSafe(at[f"_at_{c}"]) for c in layout], "left").withColumn(
        "_task", F.least(F.coalesce(task, F.lit(0)), F.lit(tasks - 1)).cast("int")).repartitionById(
        tasks, "_task").select(*rows.columns)


@dataclass(frozen=True)
class Merge:
    """One row per key: the newest by ``order``; ``first_seen`` stays at its earliest."""
    keys: Sequence[str]
    order: Callable[[], Sequence[Column]]
    first_seen: str = "loaded_at"
    buckets: int = 8


@dataclass(frozen=True)
class Table:
    path: str
    schema: str
    partition_by: Sequence[str] = field(default=())
    sort_by: Sequence[str] = field(default=())
    #: A table with a rule is laid out by buckets of its keys, not by ``partition_by``.
    merge: Merge | None = None
    #: Whether a row may hold a whole document; such rows are dealt by their bytes.
    wide: bool = False

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rpartition("/")[2]

    @property
    def store(self) -> Store:
        return Store(self.path.rstrip("/").rpartition("/")[0])

    @property
    def _layout(self) -> list[str]:
        return [BUCKET] if self.merge else list(self.partition_by)

    # -- reading

    def read(self, spark: SparkSession, months: Iterable[str] | None = None,
             state: State | None = None) -> DataFrame:
        """The table, or its rows of some months, at the newest or a given commit."""
        entries = (state or self.store.state(spark)).entries(self.name)
        if self.merge:
            rows = self._merged(spark, entries)
            return rows if months is None else rows.where(F.col(self.partition_by[0]).isin(*months))
        return self._kept(spark, entries, months)

    def rows_of(self, spark: SparkSession, entries: list[dict], months: Iterable[str] | None = None) -> DataFrame:
        """All rows of some ``add``, ``parts`` or ``full`` entries, as they were written."""
        wanted = None if months is None else {f"{self.partition_by[0]}={m}" for m in months}
        return self._union(spark, [self._files(spark, e, wanted) for e in entries if e["kind"] != "gone"])

    def _union(self, spark, frames) -> DataFrame:
        schema = _schema(self.schema)
        frames = [f for f in frames if f is not None]
        if not frames:
            return spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, frames).select(*schema.fieldNames())

    def _files(self, spark, entry: dict, wanted=None, schema: types_.StructType | None = None) -> DataFrame | None:
        base = f"{self.store.root}/{entry['dir']}"
        schema = schema or _schema(self.schema)
        if self.merge:
            schema = types_.StructType([*schema.fields, types_.StructField(BUCKET, types_.IntegerType())])
        paths = [f"{base}/{p}" if p else base for p in entry["parts"] if wanted is None or p in wanted]
        return spark.read.schema(schema).option("basePath", base).parquet(*paths) if paths else None

    def _kept(self, spark, entries: list[dict], months) -> DataFrame:
        """Rows without those whose keys a later entry calls gone. Partitions that no
        keys name are read as they are."""
        wanted = None if months is None else {f"{self.partition_by[0]}={m}" for m in months}
        plain, touched, keys = [], [], []
        for k, e in enumerate(entries):
            if e["kind"] == "gone":
                found = self._files(spark, e, wanted, _schema(e["schema"]))
                if found is not None:
                    keys.append(found.withColumn("_after", F.lit(k)))
                continue
            later = {p for g in entries[k + 1:] if g["kind"] == "gone" for p in g["parts"]}
            named = [p for p in e["parts"] if p in later]
            plain.append(self._files(spark, {**e, "parts": [p for p in e["parts"] if p not in later]}, wanted))
            found = self._files(spark, {**e, "parts": named}, wanted)
            if found is not None:
                touched.append(found.withColumn("_at", F.lit(k)))
        if not touched or not keys:
            return self._union(spark, plain + [f.drop("_at") for f in touched])
        gone, rows = reduce(DataFrame.unionByName, keys), reduce(DataFrame.unionByName, touched)
        if sum(size for e in entries if e["kind"] == "gone" for p, size in e["parts"].items()
               if wanted is None or p in wanted) > MANY_KEYS:
            gone = gone.hint("shuffle_hash")  # wide rows pass by unsorted
        on = [rows[c].eqNullSafe(gone[c]) for c in gone.columns if c != "_after"]
        return self._union(spark, [*plain, rows.join(gone, [*on, rows["_at"] < gone["_after"]], "left_anti").drop("_at")])

    def _merged(self, spark, entries: list[dict]) -> DataFrame:
        """One row per key. Keys that only the base holds are taken from it as they are;
        only rows of changed keys are brought together."""
        base = self.rows_of(spark, [e for e in entries if e["kind"] != "add"])
        added = [e for e in entries if e["kind"] == "add" and e["parts"]]
        if not added:
            return base
        new = self.rows_of(spark, added)
        keys, order = list(self.merge.keys), self.merge.order()
        if len(added) == len(entries):
            return upsert_latest(new.limit(0), new, keys, order, self.merge.first_seen)
        changed = new.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        on = [base[k].eqNullSafe(changed[f"_{k}"]) for k in keys]
        both = upsert_latest(base.join(changed, on, "left_semi"), new, keys, order, self.merge.first_seen)
        return base.join(changed, on, "left_anti").unionByName(both.select(*base.columns))

    # -- writing: ``stage`` makes files, a commit makes them count

    def stage(self, df: DataFrame, kind: str = "add", covers: Iterable[str] = ()) -> dict:
        """Write rows to a directory of their own; returns the entry for a commit."""
        return self._staged(df.select(*_schema(self.schema).fieldNames()), kind, covers, self.schema)

    def stage_gone(self, keys: DataFrame) -> dict:
        """Write keys (which include what the table is partitioned by) whose earlier rows
        shall no longer count."""
        return self._staged(keys.distinct(), "gone", (), ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in keys.schema))

    def _staged(self, rows: DataFrame, kind: str, covers, schema: str) -> dict:
        spark, entry = rows.sparkSession, f"{self.name}/{uuid.uuid4().hex}"
        target, layout = f"{self.store.root}/{entry}", self._layout
        if kind == "gone":
            layout = [c for c in layout if c in rows.columns]
        if self.merge:
            rows = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.merge.keys), self.merge.buckets).cast("int"))
        if layout and self.wide and kind != "gone":
            rows = dealt_by_bytes(rows, layout)
        elif layout:
            # rebalance splits a partition that holds most of the rows
            rows = rows.hint("rebalance", *[F.col(c) for c in layout])
        if self.sort_by and kind != "gone":
            rows = rows.sortWithinPartitions(*layout, *self.sort_by)
        rows.write.partitionBy(*layout).parquet(target)
        fs, hadoop_path = _fs(spark, target)
        found = [s.getPath() for s in _listed(spark, target) if s.isDirectory() and "=" in s.getPath().getName()]
        parts = {p.getName() if layout else "": fs.getContentSummary(p).getLength()
                 for p in (found if layout else [hadoop_path(target)])}
        out = {"dir": entry, "kind": kind, "parts": parts}
        if kind == "parts":
            out["covers"] = sorted(covers)
        if kind == "gone":
            out["schema"] = schema
        return out

    def write(self, df: DataFrame, months: Iterable[str] | None = None) -> None:
        """Commit ``df`` as the whole table, or as the new content of ``months``, also of
        those that end up without rows."""
        covers = []
        for month in months or ():
            if not _LABEL.match(month):
                raise ValueError(f"not a month label: {month!r}")
            covers.append(f"{self.partition_by[0]}={month}")
        entry = self.stage(df, "full" if months is None else "parts", covers)
        self.store.commit(df.sparkSession, lambda _: {self.name: [entry]})

    def append(self, df: DataFrame, replacing: DataFrame | None = None) -> None:
        """Commit more rows; earlier rows with the keys of ``replacing`` go."""
        entry = self.stage(df)
        gone = None if replacing is None else self.stage_gone(replacing)
        self.store.commit(df.sparkSession, lambda _: {self.name: [*([gone] if gone else []), entry]})

    def update(self, spark: SparkSession, change: Callable[[DataFrame], DataFrame]) -> None:
        """Commit the whole table anew as a function of what it is; done again from what
        another writer left if that one was first."""
        self.store.commit(spark, lambda state: {self.name: [self.stage(change(self.read(spark, state=state)), "full")]})

    def fold(self, spark: SparkSession, at_least: int = FOLD_FROM) -> int:
        """Rewrite partitions that have gathered ``at_least`` entries; returns how many."""
        done = []

        def change(state: State) -> dict:
            entries, count = state.entries(self.name), {}
            for e in entries:
                for p in e["parts"]:
                    count[p] = count.get(p, 0) + 1
            done[:] = [p for p, n in count.items() if n >= at_least]
            if not done:
                return {}
            own = [{**e, "parts": {p: s for p, s in e["parts"].items() if p in done}} for e in entries]
            rows = (self._merged if self.merge else lambda s, e: self._kept(s, e, None))(spark, [e for e in own if e["parts"]])
            return {self.name: [self.stage(rows, "parts", done)]}

        self.store.commit(spark, change)
        return len(done)

    def compact(self, spark: SparkSession) -> int:
        """One full entry instead of many; returns how many went."""
        entries = self.store.state(spark).entries(self.name)
        self.update(spark, lambda rows: rows)
        return len(entries)

    def drop_superseded(self, spark: SparkSession, keep: int = 1) -> int:
        """Delete what only commits older than the newest ``keep`` name, of all tables
        below the root."""
        return self.store.clean(spark, keep)
