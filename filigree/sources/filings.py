"""Filings in a landing folder: ``<landing>/<yyyy-mm>/**/<stem>.html``.

Folders are listed level by level, each level's folders dealt over the tasks, and files
are opened by the task that needs them, in tasks of even bytes. The driver sees months
only and content is never shuffled.
"""

from __future__ import annotations

import re
import sys
import warnings
from collections.abc import Iterable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filigree.functions import text as T
from filigree.session import shared_folder

# Workers get this module by value, so it need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUFFIXES = (".html", ".xhtml", ".xml")
MONTH_FOLDER = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")
LISTED = "source_file string, path string, ch_upload string, size bigint"
_FOUND = "path string, folder string, size bigint"
#: Bytes of one task's filings; a filing is never cut. What opening one counts for.
TASK_BYTES, OPEN_BYTES = 128 << 20, 64 << 10
#: Characters and filings from which a task hands on what it has read.
BATCH_CHARS, BATCH_FILES = 4 << 20, 256


def month_folders(spark: SparkSession, landing: str,
                  months: Iterable[str] | None = None) -> list[str]:
    """Landed month folders (yyyy-mm); asked-for months that have not landed are left
    out. Other folders are reported and not read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop_path(landing)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    landed = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    stray = [d for d in landed if not MONTH_FOLDER.match(d)]
    if stray:
        warnings.warn(f"no month folders, not read: {stray[:10]}", stacklevel=2)
    wanted = None if months is None else set(months)
    return [m for m in landed if MONTH_FOLDER.match(m) and (wanted is None or m in wanted)]


def _store(location: str):
    """File system and path in it; Hadoop's names of stores are mapped to Arrow's."""
    from pyarrow import fs

    if "://" not in location:
        return fs.LocalFileSystem(), re.sub("^file:", "", location)
    scheme, rest = location.split("://", 1)
    return fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3', 'gs': 'gcs'}.get(scheme, scheme)}://{rest}")


def _list_folders(landing: str):
    """Files and sub-folders (without a size) right in each folder; folders are named
    by their path below the landing folder."""
    def find(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                store, base = _store(f"{landing}/{folder}")
                found = [i for i in store.get_file_info(fs.FileSelector(base))
                         if not i.base_name.startswith((".", "_"))
                         and (not i.is_file or i.base_name.endswith(SUFFIXES))]
                for k in range(0, len(found), 10_000):
                    part = found[k:k + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{folder}/{i.base_name}" for i in part], pa.string()),
                        pa.array([folder.split("/")[0]] * len(part), pa.string()),
                        pa.array([i.size if i.is_file else None for i in part], pa.int64())],
                        ["path", "folder", "size"])
    return find


def list_filings(spark: SparkSession, landing: str, months: Iterable[str] | None = None,
                 work: str | None = None) -> DataFrame:
    """source_file, path, ch_upload, size. The content is not read. The month is that of
    the folder right below ``landing``, whatever else the path holds; names that begin
    with a dot or an underscore are passed over, and so is what is below them.

    The folders of one level are listed by as many tasks as there are folders, and what
    they hold is written below ``work`` (a new shared folder if None); the sub-folders
    among it are the next level. Only a folder without sub-folders is listed by one task."""
    landing = landing.rstrip("/")
    folders = month_folders(spark, landing, months)
    if not folders:
        return spark.createDataFrame([], LISTED)
    work, levels, most = work or shared_folder(spark), [], 100 * spark.sparkContext.defaultParallelism
    todo, n = spark.createDataFrame([(f,) for f in folders], "path string"), len(folders)
    while n:
        path = f"{work}/level-{len(levels)}"
        todo.repartition(min(n, most), "path").mapInArrow(_list_folders(landing), _FOUND).write.parquet(path)
        levels.append(path)
        todo = spark.read.schema(_FOUND).parquet(path).where("size IS NULL").select("path")
        n = todo.count()
    return spark.read.schema(_FOUND).parquet(*levels).where("size IS NOT NULL").select(
        F.concat(F.lit(f"{landing}/"), "path").alias("path"), "folder", "size").select(
        T.file_stem(F.col("path")).alias("source_file"), "path",
        T.folder_label(F.col("folder")).alias("ch_upload"), "size")


def even_tasks(listed: DataFrame, tasks: int | None = None, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, int]:
    """``listed`` with the task that reads each file, and how many tasks there are: runs
    of files, none of much more than ``task_bytes`` and all of about the same bytes. A
    run only exceeds the mean by less than its last file. A file also counts for what
    opening it costs. Sums are taken inside slices of the paths, then over the slices."""
    spark = listed.sparkSession
    cost = F.coalesce("size", F.lit(0)) + OPEN_BYTES
    total, files = listed.agg(F.coalesce(F.sum(cost), F.lit(0)), F.count("*")).first()
    tasks = tasks or max(spark.sparkContext.defaultParallelism, total // task_bytes + 1)
    tasks = int(max(1, min(tasks, files)))
    slices = max(1, min(4096, files // 1000))
    rows = listed.withColumn("_slice", F.pmod(F.xxhash64("path"), slices))
    before = Window.partitionBy("_slice").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    begun = rows.groupBy("_slice").agg(F.sum(cost).alias("_all")).select(  # at most 4,096 rows
        "_slice", F.coalesce(F.sum("_all").over(Window.orderBy("_slice").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_begun"))
    at = F.col("_begun") + F.coalesce("_before", F.lit(0))
    return rows.withColumn("_before", F.sum(cost).over(before)).join(begun, "_slice").withColumn(
        "task", F.least(F.floor(at * tasks / max(total, 1)), F.lit(tasks - 1)).cast("int")).drop(
        "_slice", "_before", "_begun"), tasks


def read_contents(listed: DataFrame) -> DataFrame:
    """source_file, path, ch_upload, content of listed filings, opened in tasks of even
    bytes. Bytes that are not UTF-8 are dropped, files that vanished after listing are
    left out."""
    def read(batches):
        import pyarrow as pa

        schema = pa.schema([(c, pa.string()) for c in ("source_file", "path", "ch_upload", "content")])
        found, held = [], 0
        for batch in batches:
            for file, path, label in zip(*(batch.column(i).to_pylist() for i in range(3))):
                store, inner = _store(path)
                try:
                    with store.open_input_stream(inner) as stream:
                        text = stream.read().decode("utf-8", "ignore")
                except FileNotFoundError:
                    continue
                found.append((file, path, label, text))
                held += len(text)
                if held >= BATCH_CHARS or len(found) == BATCH_FILES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], schema=schema)
                    found, held = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], schema=schema)

    rows, tasks = even_tasks(listed)
    return rows.repartitionById(tasks, "task").select("source_file", "path", "ch_upload").mapInArrow(
        read, "source_file string, path string, ch_upload string, content string")


def scan_filings(spark: SparkSession, landing: str,
                 months: Iterable[str] | None = None) -> DataFrame:
    """source_file, path, ch_upload, content: one row per file of the landing folder."""
    return read_contents(list_filings(spark, landing, months))
