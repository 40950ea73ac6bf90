"""Running values over a document, safe for one document that holds a large part
of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.sections import NOTED, SKIPPED, line_kind


def running_last(df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str, *,
                 default: str | None = None, block_rows: int = 100_000) -> DataFrame:
    """``out`` = last non-NULL ``value`` up to and including the row.

    A plain window would put a whole document in one task. Here rows are cut into
    blocks of the order column (a position); one summary row per block gives the
    value that enters it, and the window runs inside blocks only. ``order`` must be
    an integer position without NULLs.
    """
    block = F.floor(F.col(order) / block_rows)
    rows = df.withColumn("_block", block).withColumn("_value", value)
    by_block = [*keys, "_block"]

    summary = rows.groupBy(*by_block).agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_block_last"))
    before = (Window.partitionBy(*keys).orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    entering = summary.select(
        *by_block, F.last("_block_last", ignorenulls=True).over(before).alias("_entering"))

    inside = (Window.partitionBy(*by_block).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    result = rows.join(entering, by_block, "left").withColumn(
        out, F.coalesce(F.last("_value", ignorenulls=True).over(inside), "_entering"))
    if default is not None:
        result = result.withColumn(out, F.coalesce(out, F.lit(default)))
    return result.select(*[c for c in df.columns if c != out], out)


def section_lines(df: DataFrame, keys: Sequence[str], order: str, kind: Column,
                  note_heads: Sequence[int], *, block_rows: int = 100_000) -> DataFrame:
    """Lines inside sections, one row each, with ``head``, the start heading that opened
    the section. ``kind`` is that of ``functions.sections.line_kind``; ``note_heads`` are
    the headings whose sections a note number closes.

    The state before a line is the open section. What a block of lines does to it is
    told by its last heading (which sets the state) and by a note number behind that (or
    any, if the block has no heading), which closes a note section only. These effects
    are composed over the blocks of a document, one summary row each; then each block is
    worked on alone. So a document may have any number of lines. ``order`` is a position
    without NULLs; equal positions of a document are not told apart."""
    noted = F.col("_kind").isin(*NOTED)
    rows = df.withColumn("_kind", kind).withColumn("_block", F.floor(F.col(order) / block_rows))
    by_block = [*keys, "_block"]
    heading = F.when(F.col("_kind") >= 0, F.struct(F.col(order).alias("pos"), F.col("_kind").alias("kind")))
    last_note = F.max(F.when(noted, F.col(order)))
    closes = lambda head: head.isin(*note_heads) if note_heads else F.lit(False)

    effect = rows.groupBy(*by_block).agg(F.max(heading).alias("_last"), last_note.alias("_noted"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # the last heading before the block, and the last note number before it
    entering = effect.select(
        *by_block, F.max("_last").over(before).alias("_head"), F.max("_noted").over(before).alias("_note")).select(
        *by_block, F.when((F.col("_head.kind") > 0) & ~(closes(F.col("_head.kind")) & F.coalesce(
            F.col("_note") > F.col("_head.pos"), F.lit(False))), F.col("_head.kind")).alias("_entering"))

    upto = Window.partitionBy(*by_block).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.join(entering, by_block, "left").withColumn("_own", F.max(heading).over(upto)).withColumn(
        "_note", F.max(F.when(noted, F.col(order))).over(upto))
    head = F.when(F.col("_own").isNotNull(), F.col("_own.kind")).otherwise(F.col("_entering"))
    shut = closes(head) & F.coalesce(F.col("_note") > F.coalesce("_own.pos", F.lit(-1)), F.lit(False))
    return inside.withColumn("head", head).where(
        (F.col("_kind") < 0) & (F.col("head") > 0) & ~shut & ~F.col("_kind").isin(*SKIPPED)).select(
        *df.columns, "head")


def joined_lines(df: DataFrame, keys: Sequence[str], order: str, line: str, out: str, *,
                 block_rows: int = 100_000) -> DataFrame:
    """Per key the lines in order, joined by line breaks; first inside blocks of
    positions, then the blocks' texts."""
    texts = lambda pos, text: F.array_join(F.transform(F.array_sort(
        F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t")))), lambda x: x["t"]), "\n")
    blocks = df.withColumn("_block", F.floor(F.col(order) / block_rows)).groupBy(*keys, "_block").agg(
        texts(order, line).alias("_text"))
    return blocks.groupBy(*keys).agg(texts("_block", "_text").alias(out))


def sections_of_lines(df: DataFrame, keys: Sequence[str], order: str, line: str, *, starts, stops,
                      note_number: str, skips, note_sections, min_chars: int,
                      block_rows: int = 100_000) -> DataFrame:
    """``(keys, section, text)`` of documents given as rows of lines, as
    ``functions.sections.section_rows`` gives them of documents in one cell."""
    names = [name for _, name in starts]
    inside = section_lines(
        df.select(*keys, order, line), keys, order, line_kind(F.col(line), starts, stops, note_number, skips),
        [k for k, name in enumerate(names, start=1) if name in note_sections], block_rows=block_rows)
    named = inside.withColumn("section", F.element_at(F.array(*map(F.lit, names)), F.col("head")))
    return joined_lines(named, [*keys, "section"], order, line, "text", block_rows=block_rows).where(
        F.length("text") >= min_chars)
