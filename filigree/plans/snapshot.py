"""Load of one company snapshot: stage, gate, upsert, ledger."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import text as T
from filigree.operators import ledger as L
from filigree.operators.quality import rows_per_file, snapshot_gate
from filigree.operators.upserts import repeated_keys, replace_matching
from filigree.sources.schemas import register_tables
from filigree.sources.snapshot_csv import normalise_rows, read_snapshot


#: Commits that a load leaves, for queries that began before it.
KEPT_COMMITS = 8


class SnapshotRejected(RuntimeError):
    pass


def stage_snapshot(spark: SparkSession, path: str, root: str, headers=None):
    """Replace the staging table by the snapshot. Returns rows per input file."""
    tables = register_tables(root)
    raw = read_snapshot(spark, path)
    tables["staging"].write(normalise_rows(raw, headers))
    return rows_per_file(raw.select("file_name"))


def merge_companies(existing, staged, at: datetime):
    """Companies of the snapshot replace those known; companies that are missing
    from it stay."""
    return replace_matching(
        existing, staged.withColumn("loaded_at", F.lit(at).cast("timestamp")),
        ["company_number"])


def snapshot_load(spark: SparkSession, path: str, root: str, month: date, *,
                  at: datetime | None = None, tolerance: float = fv.SNAPSHOT_TOLERANCE,
                  headers=None, label: str | None = None, archive: str | None = None) -> str:
    """Run the load. Returns ``skipped`` or ``completed``; raises when the gate or
    the key check refuses the snapshot, which leaves the companies unchanged."""
    at = at or datetime.now()
    tables = register_tables(root)
    companies, months = tables["companies"], tables["month_ledger"]
    batch = spark.range(1).select(
        T.snapshot_batch_id(F.lit(month)).alias("batch_id"),
        F.coalesce(F.lit(label), F.date_format(F.lit(month), "MMMM-yyyy")).alias("ch_upload"),
        F.lit(fv.SNAPSHOT_SOURCE).alias("source"), F.lit(archive).alias("zip_filename"),
        F.lit(at).cast("timestamp").alias("started_at"))
    batch_id = batch.first()["batch_id"]
    if L.is_completed(months.read(spark), batch_id):
        return "skipped"
    months.update(spark, lambda old: L.start_batches(old, batch, relabel=True, clear_completed=False))

    def finished(old, status, done):
        outcome = batch.select(
            "batch_id", F.lit(status).alias("status"), F.lit(done).alias("files_processed"),
            F.lit(0).alias("files_failed"), F.lit(at).cast("timestamp").alias("completed_at"))
        return L.finish_batches(old, outcome)

    try:
        stage_snapshot(spark, path, root, headers)
        begun = companies.store.state(spark)
        staged, existing = tables["staging"].read(spark, state=begun), companies.read(spark, state=begun)
        gate = snapshot_gate(staged, existing, tolerance).first()
        if not gate["passed"]:
            raise SnapshotRejected(gate["reason"])
        twice = [r[0] for r in repeated_keys(staged, ["company_number"]).limit(10).collect()]
        if twice:
            raise SnapshotRejected(f"company numbers staged more than once, such as {twice}")
        missing = staged.where(F.col("company_number").isNull()).limit(1)
        if not missing.isEmpty():
            raise SnapshotRejected("rows without a company number")
        merged: dict = {}  # by what it was merged with: another writer may be first

        def change(state):
            known = json.dumps(state.entries("companies"))
            if known not in merged:
                merged[known] = companies.stage(
                    merge_companies(companies.read(spark, state=state), staged, at), "full")
            return {"companies": [merged[known]], "staging": [tables["staging"].stage(staged.limit(0), "full")],
                    "month_ledger": [months.stage(finished(months.read(spark, state=state), "completed", 1), "full")]}

        companies.store.commit(spark, change)
        companies.store.clean(spark, KEPT_COMMITS)
    except Exception:
        months.update(spark, lambda old: finished(old, "failed", 0))
        raise
    return "completed"
