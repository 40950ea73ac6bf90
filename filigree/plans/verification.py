"""Verification of loaded tables that reads what is new since the last one.

Directories of a table never change once they are committed, so what was counted in
one stays true. Counts are kept in tables of their own beside the tables they are of:
per directory of facts the rows and NULLs of each company and month, which add up; per
bucket of directors and reports the rows and repeated keys of each month, named by the
directories that the bucket consists of. A verification counts what has no counts yet,
keeps them, and puts all together. Months in which files were replaced are counted anew
until they are folded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.operators import quality as Q
from filigree.sources.schemas import register_tables
from filigree.sources.tables import State, Table

_KEYED = {"directors": ("director_rows", "duplicate_directors"), "reports": ("report_rows", "duplicate_reports")}


def _parts_of_facts(spark: SparkSession, table: Table, kept: Table, state: State) -> list[DataFrame]:
    """Frames of ``company_parts``: kept ones, and those of months with replaced files."""
    entries = state.entries(table.name)
    named = {e["dir"].rpartition("/")[2]: e for e in entries if e["kind"] != "gone"}
    replaced = {p for e in entries if e["kind"] == "gone" for p in e["parts"]}
    known = known_of(state, kept)
    new = {d: e for d, e in named.items() if d not in known}
    if new:
        counted = [Q.company_parts(table.rows_of(spark, [e]).withColumn("entry", F.lit(d)), "entry", table.partition_by[0])
                   for d, e in new.items()]
        state = _kept(spark, kept, counted, {f"entry={d}" for d in named})
    month = table.partition_by[0]
    shown = [(d, p) for d, e in named.items() for p in e["parts"] if p not in replaced]
    places = spark.createDataFrame(shown or [("", "")], "entry string, part string")
    label = F.concat(F.lit(f"{month}="), F.coalesce(F.col(month), F.lit("__HIVE_DEFAULT_PARTITION__")))
    # entries live in the state that was asked for, and their partitions that still show
    rows = kept.rows_of(spark, _only(state.entries(kept.name), {f"entry={d}" for d in named})).withColumn("part", label)
    frames = [rows.join(places, ["entry", "part"], "left_semi").drop("entry", "part")]
    if replaced:
        frames.append(Q.company_parts(
            table.read(spark, state=State(0, {table.name: _only(entries, replaced)})), month))
    return frames


def _parts_of_keys(spark: SparkSession, table: Table, kept: Table, state: State) -> DataFrame:
    """Rows and repeated keys per month, added up over the buckets."""
    month, keys, names = table.partition_by[0], list(table.merge.keys), _KEYED[table.name]
    entries = state.entries(table.name)
    buckets: dict[str, list[str]] = {}
    for e in entries:
        for p in e["parts"]:
            buckets.setdefault(p, []).append(f"{e['kind']} {e['dir']}")
    called = {f"{table.name}-{hashlib.sha256(repr((p, d)).encode()).hexdigest()[:32]}": p for p, d in buckets.items()}
    known = known_of(state, kept)
    new = {n: p for n, p in called.items() if n not in known}
    if new:
        own = State(0, {table.name: _only(entries, set(new.values()))})
        # named by bucket, which the keys tell
        at = F.pmod(F.xxhash64(*keys), table.merge.buckets).cast("string")
        name = F.create_map(*[F.lit(x) for n, p in new.items() for x in (p.partition("=")[2], n)])[at]
        rows = table.read(spark, state=own).withColumn("entry", name)
        if all(e["kind"] == "add" for e in own.entries(table.name)):  # merged: each key once
            counted = rows.groupBy("entry", month).agg(
                F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("repeated"))
        else:
            counted = rows.groupBy("entry", month, *keys).agg(F.count(F.lit(1)).alias("n")).groupBy("entry", month).agg(
                F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("repeated"))
        state = _kept(spark, kept, [counted], {f"entry={n}" for n in called}, f"entry={table.name}-")
    rows = kept.rows_of(spark, _only(state.entries(kept.name), {f"entry={n}" for n in called}))
    return rows.groupBy(month).agg(F.sum("n").alias(names[0]), F.sum("repeated").alias(names[1]))


def known_of(state: State, kept: Table) -> set[str]:
    return {p.removeprefix("entry=") for e in state.entries(kept.name) for p in e["parts"]}


def _only(entries: list[dict], parts: set[str]) -> list[dict]:
    """Entries cut down to some partitions."""
    return [{**e, "parts": {p: s for p, s in e["parts"].items() if p in parts}} for e in entries]


def _kept(spark: SparkSession, kept: Table, counted: list[DataFrame], live: set[str], own: str = "") -> State:
    """Keep counts, and let go of those (named with ``own``) of directories that no longer
    count."""
    entries = [kept.stage(df) for df in counted]

    def change(state: State) -> dict:
        stale = {p for e in state.entries(kept.name) for p in e["parts"] if p.startswith(own)} - live
        none = kept.rows_of(spark, [])
        return {kept.name: [*([kept.stage(none, "parts", stale)] if stale else []), *entries]}

    return kept.store.commit(spark, change)


def verify_tables(spark: SparkSession, root: str, months: Iterable[str] | None = None) -> DataFrame:
    """``operators.quality.verify`` of the tables below ``root`` as they are now, of all
    months that have rows or of those asked for."""
    tables = register_tables(root)
    state = tables["financials"].store.state(spark)
    facts = _parts_of_facts(spark, tables["financials"], tables["fact_checks"], state)
    every = facts[0]
    for more in facts[1:]:
        every = every.unionByName(more)
    parts = [Q.content_of_parts(every), *[_parts_of_keys(spark, tables[n], tables["key_checks"], state) for n in _KEYED]]
    asked = None if months is None else spark.createDataFrame([(m,) for m in months], "ch_upload string")
    return Q.checks_of(parts, asked)


def verified(spark: SparkSession, root: str, months: Iterable[str] | None = None) -> bool:
    return Q.verdict(verify_tables(spark, root, months))
