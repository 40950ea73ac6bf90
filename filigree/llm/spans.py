"""Places of pattern matches in whole texts, in DataFrame functions only.

Spark returns the matches of a pattern or the pieces between them, not their places.
Both together give them: a match begins after all pieces and matches before it. Sums
are taken in runs of 64, so a text with very many matches costs little more than their
number. Places are code points, from 0, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 64


def _sum(values) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once a row, however often later steps use it: a
    generator of one row keeps the optimizer from copying its expression into them."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def sums_before(df: DataFrame, name: str, lengths: str) -> DataFrame:
    """Add an array: for each element of ``lengths`` the sum of those before it."""
    runs = F.transform(F.sequence(F.lit(0), (F.size(lengths) / RUN).cast("int")),
                       lambda b: _sum(F.slice(lengths, b * RUN + 1, RUN)))
    starts = F.aggregate(runs, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    df = _held(df, "_runs", F.when(F.size(lengths) > 0, starts))
    run = lambda i: (i / RUN).cast("int")
    return df.withColumn(name, F.transform(lengths, lambda x, i: F.get("_runs", run(i)) + _sum(
        F.slice(lengths, run(i) * RUN + 1, i % RUN)))).drop("_runs")


def _places(kind: str, before: bool) -> Column:
    return F.transform(f"_m.{kind}", lambda v, i: F.struct(
        (F.get("_b", i) + F.get(f"_s.{kind}", i)["gap"]).alias("start"),
        (F.get("_b", i) + F.get("_l", i)).alias("end"), v.alias("value"),
        *([F.get(f"_s.{kind}", i)["before"].alias("before")] if before else [])))


def with_matches(df: DataFrame, text: str, kinds: dict[str, tuple[str, Column]],
                 before: int = 0) -> DataFrame:
    """Add per kind an array of ``(start, end, value)`` of its leftmost non-overlapping
    matches; with ``before``, ``(start, end, value, before)`` with as many characters
    from between the match before and this one. ``kinds``: name -> (pattern, a condition that every text with a match
    meets). ``text`` is not NULL. Patterns must not match nothing."""
    none = F.array().cast("array<string>")
    df = _held(df, "_m", F.struct(*(
        F.when(might, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none).alias(kind)
        for kind, (pattern, might) in kinds.items())))
    df = _held(df, "_s", F.struct(*(
        F.when(F.size(f"_m.{kind}") > 0, F.transform(F.arrays_zip(
            F.split(text, pattern, -1).alias("gap"), F.transform(f"_m.{kind}", F.length).alias("own")),
            lambda z: F.struct(F.length(z["gap"]).alias("gap"), F.coalesce(z["own"], F.lit(0)).alias("own"),
                               F.right(z["gap"], F.lit(before)).alias("before"))))
        .otherwise(F.array().cast("array<struct<gap:int,own:int,before:string>>")).alias(kind)
        for kind, (pattern, _) in kinds.items())))
    for kind in kinds:
        df = df.withColumn("_l", F.transform(f"_s.{kind}", lambda z: z["gap"] + z["own"]))
        df = sums_before(df, "_b", "_l")
        df = df.withColumn(kind, _places(kind, before > 0)).drop("_l", "_b")
    return df.drop("_m", "_s")


def said(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: str, spans: str, mark: str) -> Column:
    """The text with each run of overlapping spans (sorted by start) replaced by a mark."""
    whole = F.length(text)
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:int,end:int>>"),
        lambda a, s: F.when((F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["end"]), F.concat(
            F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
                F.element_at(a, -1)["start"].alias("start"),
                F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    at = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), merged,
                  F.array(F.struct(whole.alias("start"), whole.alias("end"))))
    pieces = F.transform(F.arrays_zip(F.slice(at, F.lit(1), F.size(at) - 1).alias("p"), F.slice(at, 2, F.size(at)).alias("q")),
                         lambda z: F.substring(F.col(text), z["p"]["end"] + 1, z["q"]["start"] - z["p"]["end"]))
    return F.when(F.size(spans) > 0, F.array_join(pieces, mark)).otherwise(F.col(text))
