"""File ledger and month ledger: what is done, what is new, how a run went."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import text as T
from filigree.operators.dedupe import pick_first
from filigree.session import shared_folder

FILE_KEYS = ("source_file", "ch_upload")
#: Bits of one bitmap of Spark's aggregate; sets that ``filter_heavy`` puts behind another.
BITMAP, LEVELS = 32_768, 24


# ---- what is new -------------------------------------------------------------

def new_files(files: DataFrame, ledger: DataFrame, keys: Sequence[str] = FILE_KEYS,
              statuses: Sequence[str] | None = None) -> DataFrame:
    """Files that the ledger does not hold. By default any status counts as done."""
    done = ledger if statuses is None else ledger.where(F.col("status").isin(*statuses))
    return files.join(done.select(*keys), list(keys), "left_anti")


def filter_heavy(rows: DataFrame, key_rows: DataFrame, keys: Sequence[str] = FILE_KEYS,
                 months: Iterable[str | None] | None = None, month: str = "ch_upload", *,
                 work: str | None = None, bits: int = 27) -> DataFrame:
    """Rows with large cells whose keys are in ``key_rows``, NULLs being equal. The cells
    stay where they were read, however many keys there are. ``months``, if given, are
    those of the keys, so that other partitions are not read.

    A set of bits of fixed size (two to the power of ``bits``) tells which rows may be
    wanted. The narrow keys of all rows tell exactly which of them it takes in wrongly;
    these make a second set, the wanted keys which that one would leave out a third, and
    so on until nothing is wrong, mostly at once. Only the sets, never keys, are sent to
    the tasks. Keys in between are written below ``work`` (a shared folder if None)."""
    keys, spark = list(keys), rows.sparkSession
    if months is not None:
        months = list(months)
        known = [m for m in months if m is not None]
        rows = rows.where(F.col(month).isin(*known) | (F.col(month).isNull() if None in months else F.lit(False)))
    folder = work or shared_folder(spark)

    def kept(df: DataFrame, k: int) -> DataFrame:
        df.write.parquet(f"{folder}/keys-{k}")
        return spark.read.schema(df.schema).parquet(f"{folder}/keys-{k}")

    def place(level: int):
        return F.pmod(F.xxhash64(F.lit(level), *keys), F.lit(1 << bits))

    def set_of(df: DataFrame, level: int) -> DataFrame:
        return df.select((place(level) / BITMAP).cast("int").alias(f"_at{level}"), (place(level) % BITMAP).alias("_bit")).groupBy(
            f"_at{level}").agg(F.bitmap_construct_agg("_bit").alias(f"_bits{level}"))

    def marked(df: DataFrame, level: int, bitmaps: DataFrame) -> DataFrame:
        # at most 2 ** bits / BITMAP rows of BITMAP / 8 bytes: 16 MB by default
        joined = df.withColumn("_place", place(level)).withColumn("_at", (F.col("_place") / BITMAP).cast("int")).join(
            F.broadcast(bitmaps), F.col("_at") == F.col(f"_at{level}"), "left")
        bit = (F.col("_place") % BITMAP).cast("int")
        byte = F.conv(F.hex(F.substring(f"_bits{level}", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return joined.withColumn(f"_in{level}", F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))).drop(
            "_place", "_at", f"_at{level}", f"_bits{level}")

    wanted = kept(key_rows.select(*keys).distinct(), 0)
    bitmaps, own, others = [set_of(wanted, 0)], wanted, None
    while True:
        level = len(bitmaps)
        if others is None:  # of all rows, those taken in wrongly
            passed = marked(rows.select(*keys), 0, bitmaps[0]).where("_in0").select(*keys).distinct()
            wrong = passed.join(wanted.select(*[F.col(k).alias(f"_{k}") for k in keys]),
                                [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
        else:  # of the set before, those that the newest one takes in
            wrong = marked(others, level - 1, bitmaps[-1]).where(f"_in{level - 1}").select(*keys)
        wrong = kept(wrong, level)
        if wrong.isEmpty():
            break
        if level >= LEVELS:  # far more keys than bits: a plain join says it
            return rows.join(wanted.select(*[F.col(k).alias(f"_{k}") for k in keys]),
                             [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi")
        bitmaps.append(set_of(wrong, level))
        own, others = wrong, own
    found = rows
    for level, bitmap in enumerate(bitmaps):
        found = marked(found, level, bitmap)
    inside = F.lit(True)
    for level in reversed(range(1, len(bitmaps))):
        inside = ~(F.col(f"_in{level}") & inside)
    return found.where(F.col("_in0") & inside).select(*rows.columns)


def pending_months(plan: DataFrame, month_ledger: DataFrame) -> DataFrame:
    done = month_ledger.where(F.col("status") == "completed")
    return plan.join(done.select("ch_upload"), "ch_upload", "left_anti")


def completed_among(batches: DataFrame, month_ledger: DataFrame, key: str = "batch_id"):
    done = month_ledger.where(F.col("status") == "completed")
    return batches.join(done.select(key), key, "left_semi")


def is_completed(month_ledger: DataFrame, batch_id: str) -> bool:
    found = month_ledger.where(
        (F.col("batch_id") == batch_id) & (F.col("status") == "completed"))
    return not found.limit(1).isEmpty()


def source_files(*outputs: DataFrame, keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """Distinct source files that gave at least one row in any output."""
    names = [df.select(*keys) for df in outputs]
    merged = names[0]
    for more in names[1:]:
        merged = merged.union(more)
    return merged.distinct()


# ---- file ledger ----------------------------------------------------------------

def ledger_upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str] = FILE_KEYS,
                  at: str = "processed_at") -> DataFrame:
    """Latest entry per key; of two entries at the same time the new one stays."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    order = [F.col(at).desc_nulls_last(), F.col("_new").desc()]
    return pick_first(both, keys, order).drop("_new")


def numbered_warnings(warnings: DataFrame, keys: Sequence[str], order: str,
                      text: str = "warning") -> DataFrame:
    """All ``ixt`` warnings, one row each: keys, ``n`` (from 1 in each file), warning."""
    return warnings.where(T.is_format_warning(F.col(text))).select(*keys, F.row_number().over(
        Window.partitionBy(*keys).orderBy(order)).alias("n"), F.col(text).alias("warning"))


def warning_comments(numbered: DataFrame, keys: Sequence[str], file_name: Column) -> DataFrame:
    """One ledger comment per file. It is cut to 2,000 characters and a numbered line
    takes at least six, so only the first 400 lines are gathered for it; the count
    covers all, and the table of numbered warnings keeps all."""
    line = F.when(F.col("n") <= fv.COMMENT_CHARS // 5, F.struct("n", "warning"))
    return numbered.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_warnings"),
        F.transform(F.array_sort(F.collect_list(line)),
                    lambda x: T.numbered_line(x["n"], x["warning"])).alias("_lines")).withColumn(
        "comment", T.comment(T.warning_comment(file_name, F.col("n_warnings"), F.col("_lines")))).drop("_lines")


# ---- month ledger -----------------------------------------------------------------

MONTH_COLUMNS = ("batch_id", "ch_upload", "source", "zip_filename", "status",
                 "files_processed", "files_failed", "started_at", "completed_at", "loaded_at")


def start_batches(ledger: DataFrame, starts: DataFrame, *, relabel: bool = False,
                  clear_completed: bool = True) -> DataFrame:
    """Mark batches as running. ``starts``: batch_id, ch_upload, source,
    zip_filename, started_at. A new batch starts at 0/0; a known one keeps its
    counts. ``relabel`` takes label and archive name from the new start."""
    old, new = ledger.alias("o"), starts.alias("n")
    joined = old.join(new, F.col("o.batch_id") == F.col("n.batch_id"), "full_outer")
    known, started = F.col("o.batch_id").isNotNull(), F.col("n.batch_id").isNotNull()

    def text_of(c):
        newer = F.coalesce(f"n.{c}", f"o.{c}") if relabel else F.coalesce(f"o.{c}", f"n.{c}")
        return F.when(started & ~known, F.col(f"n.{c}")).otherwise(newer).alias(c)

    return joined.select(
        F.coalesce("o.batch_id", "n.batch_id").alias("batch_id"),
        text_of("ch_upload"),
        F.coalesce("o.source", "n.source").alias("source"),
        text_of("zip_filename"),
        F.when(started, "running").otherwise(F.col("o.status")).alias("status"),
        F.when(known, F.col("o.files_processed")).otherwise(0).alias("files_processed"),
        F.when(known, F.col("o.files_failed")).otherwise(0).alias("files_failed"),
        F.when(started, F.col("n.started_at")).otherwise(F.col("o.started_at")).alias("started_at"),
        (F.when(started, F.lit(None)).otherwise(F.col("o.completed_at")) if clear_completed
         else F.col("o.completed_at")).cast("timestamp").alias("completed_at"),
        F.when(started, F.col("n.started_at")).otherwise(F.col("o.loaded_at")).alias("loaded_at"),
    )


def finish_batches(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Close known batches. ``outcomes``: batch_id, status, files_processed,
    files_failed, completed_at. Unknown batches are ignored, as by an UPDATE."""
    done = outcomes.select("batch_id", F.lit(True).alias("_done"), *[
        F.col(c).alias(f"_{c}")
        for c in ("status", "files_processed", "files_failed", "completed_at")])
    joined = ledger.join(done, "batch_id", "left")

    def pick(new, old):
        return F.when(F.col("_done"), F.col(new)).otherwise(F.col(old)).alias(old)

    changed = {"status": "_status", "files_processed": "_files_processed",
               "files_failed": "_files_failed", "completed_at": "_completed_at",
               "loaded_at": "_completed_at"}
    return joined.select(*[pick(changed[c], c) if c in changed else F.col(c)
                           for c in MONTH_COLUMNS])


def insert_absent(existing: DataFrame, new: DataFrame, key: str = "batch_id") -> DataFrame:
    absent = new.join(existing.select(key), key, "left_anti")
    return existing.unionByName(absent)


# ---- how a run went -----------------------------------------------------------------

def _in_run(ledger: DataFrame, since) -> DataFrame:
    return ledger if since is None else ledger.where(F.col("processed_at") >= F.lit(since))


def run_counts(ledger: DataFrame, since=None, by: Sequence[str] = ("ch_upload",)) -> DataFrame:
    status = F.col("status")
    return _in_run(ledger, since).groupBy(*by).agg(
        F.count_if(status == "success").alias("files_processed"),
        F.count_if(status == "failed").alias("files_failed"),
        F.count_if(status == "warning").alias("files_warned"))


def month_outcome(counts: DataFrame) -> DataFrame:
    """Failed only when nothing succeeded and something failed."""
    all_failed = (F.col("files_processed") == 0) & (F.col("files_failed") > 0)
    return counts.withColumn("status", F.when(all_failed, "failed").otherwise("completed"))


def with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "success_rate", T.success_rate(F.col("files_processed"), F.col("files_failed")))


def failed_files(ledger: DataFrame, since=None) -> DataFrame:
    return (
        _in_run(ledger, since).where(F.col("status") == "failed")
        .select("source_file", "ch_upload", "comment", "processed_at")
        .orderBy("processed_at", "source_file"))


def total_processed(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count(F.lit(1)).alias("total_processed"))


def stored_count(month_ledger: DataFrame, label: Column | str) -> DataFrame:
    """Processed files recorded for a month, 0 when there is no record."""
    return month_ledger.where(F.col("ch_upload") == label).agg(
        F.coalesce(F.max("files_processed"), F.lit(0)).alias("files_processed"))


def latest_completed(month_ledger: DataFrame) -> DataFrame:
    return (
        month_ledger.where(F.col("status") == "completed")
        .orderBy(F.col("completed_at").desc_nulls_last(), F.col("batch_id").desc())
        .limit(1))


def latest_runs(month_ledger: DataFrame) -> DataFrame:
    """Newest ledger row per month with its duration in seconds."""
    cols = ("status", "files_processed", "files_failed", "started_at", "completed_at")
    return (
        month_ledger.groupBy("ch_upload")
        .agg(F.max_by(F.struct(*cols), F.struct("started_at", "batch_id")).alias("_run"))
        .select("ch_upload", *[F.col("_run")[c].alias(c) for c in cols])
        .withColumn("duration_seconds", F.unix_timestamp("completed_at")
                    - F.unix_timestamp("started_at")))


# ---- plans -----------------------------------------------------------------------------

def month_plan(spark: SparkSession, start, now, limit: int = 0) -> DataFrame:
    """Months from start to now, oldest first; the first ``limit`` when positive."""
    first, last = (F.trunc(F.lit(str(d)).cast("date"), "MM") for d in (start, now))
    plan = (
        spark.range(1).where(first <= last)
        .select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))
        .withColumn("ch_upload", T.month_label(F.col("month")))
        .orderBy("month"))
    return plan.limit(limit) if limit > 0 else plan


def sample_files(files: DataFrame, n: int, by: str = "path") -> DataFrame:
    return files.orderBy(by).limit(n)
