"""Upserts as plain joins and aggregates; the caller writes the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions.text import label_month


def replace_matching(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``new``, plus all of ``new``."""
    keys = list(keys)
    kept = existing.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def upsert_latest(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                  order: Sequence[Column], first_seen: str = "loaded_at") -> DataFrame:
    """Newest row per key over both inputs; ``first_seen`` stays at its earliest.

    One aggregate with map-side merging does both, so the table is shuffled once
    and a hot key is reduced before the shuffle. NULLs sort lowest.
    """
    keys = list(keys)
    rest = [c for c in existing.columns if c not in keys and c != first_seen]
    # the order is worked out once per row, not in each comparison
    both = existing.unionByName(new).select(
        *keys, first_seen, F.struct(*rest).alias("_row"), F.struct(*order, F.col(first_seen)).alias("_order"))
    return (
        both.groupBy(*keys).agg(F.max_by("_row", "_order").alias("_row"), F.min(first_seen).alias(first_seen))
        .select(*[F.col("_row")[c].alias(c) if c in rest else F.col(c)
                  for c in existing.columns])
    )


def filing_order(*then: str) -> list[Column]:
    """Order of filings for ``upsert_latest``: month, filing date, file name."""
    return [label_month(F.col("ch_upload")).alias("_month"), F.col("filing_date"),
            F.col("source_file"), *[F.col(c) for c in then]]
