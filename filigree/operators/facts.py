"""From facts of filings to the rows of the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import text as T
from filigree.operators.dedupe import distinct_texts, first_wins
from filigree.operators.running import running_last


def lookup_table(spark: SparkSession, pairs: dict, key: str, value: str) -> DataFrame:
    import pyarrow as pa

    return spark.createDataFrame(
        pa.table({key: list(pairs.keys()), value: list(pairs.values())}))


def map_tags(df: DataFrame, pairs: dict, tag: str, out: str) -> DataFrame:
    """Keep rows whose tag is mapped and add what it maps to. The lookup is a
    literal of the program (tens of rows), so it is broadcast."""
    spark = df.sparkSession
    table = lookup_table(spark, pairs, tag, out)
    return df.join(F.broadcast(table), tag, "inner")


def with_context_dates(facts: DataFrame, contexts: DataFrame,
                       keys: Sequence[str] = ("source_file", "context_ref")) -> DataFrame:
    """Optional equi-join of facts to the dates of their context."""
    return facts.join(
        contexts.select(*keys, "instant", "start_date", "end_date"), list(keys), "left")


def with_period(df: DataFrame) -> DataFrame:
    """Add period, closing date and fiscal year from instant / start / end."""
    closing = T.closing_day(F.col("period"), F.col("instant"), F.col("end_date"))
    return (
        df.withColumn("period", T.period_label(
            F.col("instant"), F.col("start_date"), F.col("end_date")))
        .withColumn("account_closing_date_last_year", closing.try_cast("date"))
        .withColumn("fiscal_period_new", T.fiscal_year(closing))
    )


def first_metric_facts(facts: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Mapped numeric facts, one per (document, metric, dates)."""
    mapped = map_tags(facts, fv.METRIC_TAGS, "tag", "metric")
    return first_wins(
        mapped, [*doc, "metric", "start_date", "end_date", "instant"], "ord", "value")


def director_rows(facts: DataFrame, doc: Sequence[str], tag: str = fv.DIRECTOR_TAG) -> DataFrame:
    named = facts.where(F.col("tag") == tag)
    return distinct_texts(named, list(doc), "value", "ord").withColumnRenamed(
        "value", "director_name")


def is_related_party_text(tag: Column, value: Column,
                          min_chars: int = fv.MIN_RELATED_PARTY_CHARS) -> Column:
    return (tag == fv.RELATED_PARTY_TAG) & (F.length(value) >= min_chars)


def field_rows(facts: DataFrame) -> DataFrame:
    """Metadata facts as field/value rows; long related-party texts go elsewhere."""
    short = facts.where(
        (F.col("value") != "") & ~is_related_party_text(F.col("tag"), F.col("value")))
    return map_tags(short, fv.FIELD_TAGS, "tag", "field")


def unpivot_fields(df: DataFrame, ids: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Wide columns to non-empty field/value rows."""
    wide = df.select(*ids, *[T.text_value(F.col(c).cast("string")).alias(c) for c in fields])
    return wide.unpivot(list(ids), list(fields), "field", "value").where(F.col("value") != "")


def related_party_texts(facts: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Long related-party texts with the company name seen so far ('' before any)."""
    own = facts.where(
        ((F.col("tag") == fv.COMPANY_NAME_TAG) & (F.col("value") != ""))
        | is_related_party_text(F.col("tag"), F.col("value")))
    named = running_last(
        own, list(doc), "ord",
        F.when(F.col("tag") == fv.COMPANY_NAME_TAG, F.col("value")), "company_name", default="")
    return named.where(F.col("tag") == fv.RELATED_PARTY_TAG).select(
        *doc, "ord", "company_name", F.lit(fv.RELATED_PARTY_SECTION).alias("section"),
        F.col("value").alias("text"))
