"""Checks after a load: counts, NULLs, duplicates, and the snapshot gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree import fixed_values as fv

CHECKS = (
    "financial_rows", "companies", "null_company_number", "null_metric", "null_value",
    "director_rows", "duplicate_directors", "report_rows", "duplicate_reports",
)


def company_parts(facts: DataFrame, *by: str) -> DataFrame:
    """Rows and NULLs per company: parts of ``content_checks`` that add up."""
    return facts.groupBy(*by, "company_number").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("metric").isNull()).alias("no_metric"),
        F.count_if(F.col("value").isNull()).alias("no_value"))


def content_of_parts(parts: DataFrame, by: str = "ch_upload") -> DataFrame:
    """``content_checks`` of the facts that ``company_parts`` were made of, however many."""
    return parts.groupBy(by).agg(
        F.sum("n").alias("financial_rows"), F.countDistinct("company_number").alias("companies"),
        F.coalesce(F.sum(F.when(F.col("company_number").isNull(), F.col("n"))), F.lit(0)).alias("null_company_number"),
        F.sum("no_metric").alias("null_metric"), F.sum("no_value").alias("null_value"))


def content_checks(facts: DataFrame, by: str = "ch_upload") -> DataFrame:
    """Rows, companies and NULLs in one pass over the fact table."""
    return facts.groupBy(by).agg(
        F.count(F.lit(1)).alias("financial_rows"),
        F.countDistinct("company_number").alias("companies"),
        F.count_if(F.col("company_number").isNull()).alias("null_company_number"),
        F.count_if(F.col("metric").isNull()).alias("null_metric"),
        F.count_if(F.col("value").isNull()).alias("null_value"))


def key_checks(df: DataFrame, keys: Sequence[str], rows: str, duplicates: str,
               by: str = "ch_upload") -> DataFrame:
    """Rows and number of keys that occur more than once, in one pass."""
    return df.groupBy(by, *keys).agg(F.count(F.lit(1)).alias("_n")).groupBy(by).agg(
        F.sum("_n").alias(rows), F.count_if(F.col("_n") > 1).alias(duplicates))


def verify(financials: DataFrame, directors: DataFrame, reports: DataFrame,
           months: DataFrame | None = None, by: str = "ch_upload") -> DataFrame:
    """One row per month and check: value and level. Missing financial rows are an
    error, NULLs and duplicates only warn. Without ``months`` every month that has
    rows is checked."""
    return checks_of([
        content_checks(financials, by),
        key_checks(directors, ("company_number", "director_name"),
                   "director_rows", "duplicate_directors", by),
        key_checks(reports, ("company_number", "section"),
                   "report_rows", "duplicate_reports", by)], months, by)


def checks_of(parts: list[DataFrame], months: DataFrame | None = None, by: str = "ch_upload") -> DataFrame:
    """One row per month and check, from a few numbers per month and table."""
    if months is not None:
        asked = months.select(by).distinct()
        parts = [asked, *[part.join(asked, by, "left_semi") for part in parts]]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    wide = found.groupBy(by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in CHECKS])
    value, check = F.col("value"), F.col("check_name")
    return wide.unpivot([by], list(CHECKS), "check_name", "value").withColumn(
        "level", F.when((check == "financial_rows") & (value == 0), "error")
        .when((check.startswith("null_") | check.startswith("duplicate_")) & (value > 0), "warning")
        .otherwise("ok"))


def verdict(checks: DataFrame) -> bool:
    return checks.where(F.col("level") == "error").limit(1).isEmpty()


def snapshot_gate(staged: DataFrame, previous: DataFrame,
                  tolerance: float = fv.SNAPSHOT_TOLERANCE) -> DataFrame:
    """One row: both counts, their ratio, the verdict and why."""
    n, zero = F.count(F.lit(1)), F.lit(0).cast("bigint")
    counts = (
        staged.agg(n.alias("staged_rows"), F.any_value(zero).alias("previous_rows"))
        .unionByName(previous.agg(n.alias("previous_rows"), F.any_value(zero).alias("staged_rows")))
        .agg(F.coalesce(F.sum("staged_rows"), zero).alias("staged_rows"),
             F.coalesce(F.sum("previous_rows"), zero).alias("previous_rows")))
    s, p = F.col("staged_rows"), F.col("previous_rows")
    ratio = F.when(p > 0, s / p)
    short = (p > 0) & (ratio < tolerance)
    return counts.select(
        s, p, ratio.alias("ratio"),
        ((s > 0) & ~short).alias("passed"),
        F.when(s == 0, "staging is empty")
        .when(short, F.format_string(
            "staged %d of %d previous rows, below the tolerance", s, p))
        .otherwise("OK").alias("reason"))


def rows_per_file(df: DataFrame, file: str = "file_name") -> DataFrame:
    """Rows per input file and a TOTAL line."""
    return df.rollup(file).agg(
        F.count(F.lit(1)).alias("row_count"), F.grouping(file).alias("_total")
    ).select(F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col(file)).alias("file_name"),
             "row_count")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    merged = counts[0]
    for more in counts[1:]:
        merged = merged.unionByName(more)
    return merged


def latest_snapshot(landed: DataFrame, run_date, month: str = "month") -> DataFrame:
    """Newest landed month among the run month and the two before it."""
    run_month = F.trunc(F.lit(str(run_date)).cast("date"), "MM")
    return landed.where(F.col(month).between(F.add_months(run_month, -2), run_month)).agg(
        F.max(month).alias(month))
