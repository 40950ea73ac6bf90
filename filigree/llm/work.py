"""Where the operators keep what they cut their lineage with."""

from __future__ import annotations

import gc
import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bits of one of Spark's bitmaps.
BITMAP = 1 << 15


def folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, as in tests,
    it is set to a folder of the warehouse, which a cluster shares as well."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Folders of the tables that are not yet let go, oldest first.
_made: list[str] = []


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows survives the
    loss of executors without computing it again."""
    spark = df.sparkSession
    top = folder(spark)
    _made.append(top)
    df.write.option("compression", "zstd").parquet(f"{top}/{name}")
    return spark.read.schema(df.schema).parquet(f"{top}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def restored(df: DataFrame, name: str = "table") -> DataFrame:
    """As ``stored``, in place of the table stored last, which goes."""
    df = stored(df, name)
    _delete(df.sparkSession, _made.pop(-2))
    return df


def let_go(df: DataFrame) -> None:
    """Delete a table that ``stored`` gave: nothing that is still to be computed may need it."""
    at = next(iter(df.inputFiles()), "")
    for top in [t for t in _made if f"/{t.rpartition('/')[2]}/" in at]:
        _made.remove(top)
        _delete(df.sparkSession, top)


def freed(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files that nothing needs any more. It does so when
    the driver collects its garbage, which without this may be after the whole job."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def temporary(spark: SparkSession):
    """Tables stored inside are deleted at the end, but for the one given to what this
    yields: nothing that is still to be computed may need the others."""
    since, kept = len(_made), []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(_made.pop())
        return df

    yield keep
    while len(_made) > since:
        _delete(spark, _made.pop())
    _made.extend(kept)


def _unused(df: DataFrame, name: str) -> str:
    while name in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a row number behind, and that column's name. It is written, so every
    reading gives a row the same number."""
    name = _unused(df, "_row")
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def bitmaps(places: DataFrame) -> DataFrame:
    """``(block, bits)`` of a table of one column of whole numbers, none negative or NULL.
    Narrow rows are dealt by block first: partial bitmaps of every task would be as many
    as tasks and blocks together."""
    at = F.col(f"`{places.columns[0]}`").cast("long")
    return places.select(F.shiftright(at, 15).alias("block"), at.bitwiseAND(F.lit(BITMAP - 1)).alias("bit")).repartition(
        "block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bit_is_set(bits, place):
    """Whether ``bits``, of the block of ``place``, holds it. NULL if there are none."""
    bit = place.bitwiseAND(F.lit(BITMAP - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1


def only(df: DataFrame, row: str, picked: DataFrame, stay: bool = True) -> DataFrame:
    """Rows of ``df``, as ``numbered`` gave them, whose number ``picked`` (one column)
    holds, or (not ``stay``) does not; without the number. ``df`` is read in place,
    whatever the sizes: all tasks get the picked numbers as bits, one a row of ``df``."""
    block, bits = _unused(df, "_block"), _unused(df, "_bits")
    sets = stored(bitmaps(picked).toDF(block, bits), "bits")
    held = F.coalesce(bit_is_set(F.col(bits), F.col(row)), F.lit(False))
    return df.join(F.broadcast(sets), F.shiftright(df[row], 15) == sets[block], "left").where(
        held if stay else ~held).drop(block, bits, row)


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where it is; on a
    cluster it is installed or sent with the job."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Hand at most ``rows`` whole texts at a time to Python workers. The setting is
    read when a result is computed, so it has to stay set."""
    importable(spark)
    if int(spark.conf.get(BATCH)) > rows:
        spark.conf.set(BATCH, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
