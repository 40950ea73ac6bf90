"""From raw documents to token ids: the corpus operators, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.llm import decontaminate, pieces, secrets, simhash, toxicity
from filigree.llm.work import numbered, only, stored, table, temporary


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labels of these documents, does not
    find toxic."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose fingerprints (of 3-word shingles) are linked by
    at most 3 differing bits one row, that with the smallest id."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark, whatever rows share their id."""
    docs, row = numbered(docs)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), doc_id=row)
    return only(docs, row, found.where("contaminated").select("doc_id"), stay=False)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` counts what is left."""
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_crc32``, ``exact`` and ``ids`` of each document."""
    return pieces.encoded(docs)


STAGES = [
    ("toxicity", toxicity_stage), ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage), ("secrets", secrets_stage), ("encoding", encoding_stage),
]
#: A trained network and suffix-array matching are not SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary(spark) as keep:  # a stage's working tables go once its rows are written
            docs = keep(stored(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
