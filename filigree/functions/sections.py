"""Report sections of a marked-up document.

A document is one cell, so its lines are worked on in place as an array: text is
never exploded, shuffled or sorted. The state machine is read off the heading
lines: each heading opens a segment that runs to the next start or stop heading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions.text import begins_with, strip

# Line kinds; start headings are numbered from 1.
_STOP, _TEXT, _SKIP, _NOTE, _NOTE_OR_SKIP = 0, -1, -2, -3, -4
NOTED, SKIPPED = (_NOTE, _NOTE_OR_SKIP), (_SKIP, _NOTE_OR_SKIP)


def lines(content: Column) -> Column:
    """Non-blank trimmed lines of the text between tags, in order."""
    broken = F.regexp_replace(content, r"<[^>]++>", "\n")
    return F.filter(F.transform(F.split(broken, "\n"), strip), lambda line: line != "")


def line_kind(line: Column, starts=fv.SECTION_STARTS, stops=fv.SECTION_STOPS,
              note_number=fv.NOTE_NUMBER, skips=fv.SECTION_SKIPS) -> Column:
    """k for the k-th start heading, 0 for a stop heading, negative otherwise.
    Patterns are matched from the start of the line."""
    # most lines are plain text: one combined search settles them
    every = [p for p, _ in starts] + [*stops, note_number, *skips]
    kind = F.when(~begins_with(line, *every), _TEXT)
    for k, (pattern, _) in enumerate(starts, start=1):
        kind = kind.when(begins_with(line, pattern), k)
    skip, note = begins_with(line, *skips), begins_with(line, note_number)
    return (
        kind.when(begins_with(line, *stops), _STOP)
        .when(note & skip, _NOTE_OR_SKIP).when(note, _NOTE).when(skip, _SKIP)
        .otherwise(_TEXT)
    )


def text_lines(df: DataFrame, content: str, *keep: str) -> DataFrame:
    """One row per line: the kept columns, ``pos`` from 0, ``line``."""
    # the outer form: for the inner one Spark adds a filter that splits the text twice
    return df.select(
        *keep, F.posexplode_outer(lines(F.col(content))).alias("pos", "line")
    ).where(F.col("pos").isNotNull())


def with_sections(
    df: DataFrame, content: str, out: str = "sections", *,
    starts=fv.SECTION_STARTS, stops=fv.SECTION_STOPS, note_number=fv.NOTE_NUMBER,
    skips=fv.SECTION_SKIPS, note_sections=fv.NOTE_SECTIONS, min_chars=fv.MIN_SECTION_CHARS,
) -> DataFrame:
    """Add ``out``: array<struct<section, text>> of the sections long enough to keep."""
    kept = df.columns
    kinds = lambda ls: F.transform(ls, lambda x: line_kind(x, starts, stops, note_number, skips))
    note_kinds = [k for k, (_, name) in enumerate(starts, start=1) if name in note_sections]
    skipped = lambda kind: kind.isin(_SKIP, _NOTE_OR_SKIP)

    marked = (
        df.withColumn("_lines", lines(F.col(content)))
        .withColumn("_kinds", kinds(F.col("_lines")))
        # positions of the headings; the end of the document closes the last one
        .withColumn("_heads", F.concat(
            F.filter(
                F.transform(F.col("_kinds"), lambda kind, i: F.when(kind >= _STOP, i)),
                lambda i: i.isNotNull()),
            F.array(F.size("_kinds"))))
    )

    def segment(head, n):
        begin = head + 1
        count = F.greatest(F.get(F.col("_heads"), n + 1) - begin, F.lit(0))
        return F.struct(
            F.get(F.col("_kinds"), head).alias("head"),
            F.arrays_zip(
                F.slice("_lines", begin + 1, count).alias("line"),
                F.slice("_kinds", begin + 1, count).alias("kind")).alias("body"))

    # position of the note number that closes a note section
    def with_cut(seg):
        first_note = F.array_min(F.transform(seg["body"], lambda x, i: F.when(
            x["kind"].isin(_NOTE, _NOTE_OR_SKIP), i)))
        return F.struct(
            seg["head"].alias("head"), seg["body"].alias("body"),
            F.coalesce(F.when(seg["head"].isin(*note_kinds), first_note),
                       F.size(seg["body"])).alias("cut"))

    def body_text(seg):
        kept_lines = F.filter(seg["body"], lambda x, i: (i < seg["cut"]) & ~skipped(x["kind"]))
        return F.struct(
            seg["head"].alias("head"),
            F.transform(kept_lines, lambda x: x["line"]).alias("lines"))

    segments = (
        marked.withColumn("_segs", F.filter(
            F.transform(
                F.slice("_heads", F.lit(1), F.size("_heads") - 1), segment),
            lambda s: s["head"] > _STOP))
        .withColumn("_segs", F.transform(F.transform("_segs", with_cut), body_text))
    )
    names = list(dict.fromkeys(name for _, name in starts))
    kinds_of = {n: [k for k, (_, m) in enumerate(starts, 1) if m == n] for n in names}

    def joined(name):
        own = F.filter("_segs", lambda s: s["head"].isin(*kinds_of[name]))
        return F.struct(
            F.lit(name).alias("section"),
            F.array_join(F.flatten(F.transform(own, lambda s: s["lines"])), "\n").alias("text"))

    return (
        segments.withColumn("_all", F.array(*[joined(n) for n in names]))
        .withColumn(out, F.filter("_all", lambda s: F.length(s["text"]) >= min_chars))
        .select(*[c for c in kept if c != out], out)
    )


def section_rows(df: DataFrame, content: str, *keep: str, **patterns) -> DataFrame:
    """One row per section: the kept columns, ``section``, ``text``."""
    found = with_sections(df.select(*keep, content), content, "_found", **patterns)
    # the outer form, as in ``text_lines``: nothing is pushed into the array steps
    return found.select(*keep, F.inline_outer("_found")).where(F.col("section").isNotNull())
