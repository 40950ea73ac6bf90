"""Register of runnable queries: a Spark function and, where there is one, the SQL
that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.sources.filings import _store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# SQL literal of all blanks, and a trim that removes them
BLANKS = f"'{fv.WHITESPACE}'"


def sql_strip(expression: str) -> str:
    return f"trim({expression}, {BLANKS})"


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows evenly over all cores before work that makes each of them large; a
    table may have all its rows in one of its splits."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def write_filings(df: DataFrame, landing: str, directory: str = "directory",
                  name: str = "file_name", content: str = "content") -> int:
    """Write each row as one file of a landing folder; returns how many."""

    def export(batches):
        import pyarrow as pa

        store, root = _store(landing)
        made = set()
        for batch in batches:
            for folder, file, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if folder not in made:
                    store.create_dir(f"{root}/{folder}", recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{root}/{folder}/{file}") as out:
                    out.write(text.encode("utf-8"))
            yield pa.RecordBatch.from_pydict({"written": [batch.num_rows]})

    written = df.select(directory, name, content).mapInArrow(export, "written bigint")
    return written.agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]
