"""Session and working-folder helpers."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Filings are large rows, so Python workers get few of them at a time; small
# files are packed by their size, not by a 4 MB opening cost each.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    _BATCH: "16",
    "spark.sql.files.openCostInBytes": "262144",
}


def build_session(app: str = "filigree", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``, or below its
    warehouse, which is shared as well, where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work")
    return f"{base.rstrip('/')}/filigree-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256, size: int = 8 << 20):
    """Hand few rows and bytes at a time to Python workers while whole documents are
    parsed: the default of 10,000 filings would not fit in one Arrow batch."""
    before = {_BATCH: spark.conf.get(_BATCH), _BATCH_BYTES: spark.conf.get(_BATCH_BYTES)}
    spark.conf.set(_BATCH_BYTES, str(size))
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
