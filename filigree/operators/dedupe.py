"""De-duplication by key. Every form keeps at most one row per key and map task
before the shuffle, so a key that holds a large part of all rows stays cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.text import label_month


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key. ``row_number() = 1`` lets Spark limit each group
    before the exchange as well (WindowGroupLimit)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_wins(df: DataFrame, keys: Sequence[str], order: str, value: str | None = None):
    """First in document order wins; only then are NULL values dropped, so a NULL
    first occurrence hides a later value."""
    first = pick_first(df, keys, [F.col(order).asc_nulls_last()])
    return first if value is None else first.where(F.col(value).isNotNull())


def distinct_texts(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Distinct non-empty texts per key, first occurrence kept."""
    return first_wins(df.where(F.col(value) != ""), [*keys, value], order)


def recency(label: str = "ch_upload", *then: str) -> list[Column]:
    """Newest first: month of the label, then the given columns."""
    return [label_month(F.col(label)).desc_nulls_last(),
            *[F.col(c).desc_nulls_last() for c in then]]


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row per key, by a stated order instead of arrival order."""
    return pick_first(df, keys, order)


def last_value_per_key(df: DataFrame, keys: Sequence[str], value: Column, order: str,
                       out: str) -> DataFrame:
    """Last non-NULL value per key, as a partial aggregate (no sort, no window)."""
    return df.groupBy(*keys).agg(
        F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(out))
