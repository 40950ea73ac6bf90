"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A benchmark item is a set of windows (13 consecutive words, or the whole of a shorter
item) and a window is a set of one-word shingles. Shingles are ordered by how often
they occur in all documents, the rarest first. Exact containment needs all shingles of
a window, so its rarest one is the only prefix token that has to be joined. A match
fixes where the window would start; it is dropped if it would start before the
document's first word or end after its last (position and length bounds), and the words
there are then compared with the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.work import stored, table

WINDOW = 13
#: Up to so many prefix tokens (a few MB) are sent to where the words are; a larger
#: benchmark first finds the places of its tokens on narrow rows.
SENT_TOKENS = 200_000
#: Words whose surroundings are laid out at a time.
CHUNK = 256
#: Between words: every ASCII character but 0-9 and a-z (A-Z are lower-cased before).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, SEPARATORS), "")


def listed(base: DataFrame) -> DataFrame:
    """``base`` with the words as arrays, one row's at a time. They are stored as one
    string: a batch of rows that is read has a string's bytes in memory instead of
    several numbers, and as much again to grow, for each word of thousands of texts."""
    return base.withColumn("w", F.array_remove(F.split("w", " "), ""))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``(win, items)``: each distinct window with the ids of its items, as strings."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return w.where(F.size("w") > 0).select(
        "item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("win")
    ).groupBy("win").agg(F.collect_set("item").alias("items"))


def rarest(base: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` with the prefix token of each and its place in the window. A window
    with a word that no document has can't occur and is left out."""
    vocabulary = stored(windows.select(F.explode("win").alias("token")).distinct().coalesce(1), "words")
    counts = listed(base).select(F.explode("w").alias("token")).join(vocabulary, "token", "left_semi") \
        .groupBy("token").agg(F.count("*").alias("n"))
    places = windows.select("wid", F.posexplode("win").alias("at", "token"))
    first = places.join(counts, "token", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")).alias("r"))
    return windows.join(first.where("r.n > 0"), "wid").select(
        "win", "items", F.col("r.token").alias("token"), F.col("r.at").alias("at"))


def surroundings(base: DataFrame, tokens: DataFrame, window: int, sent: int = SENT_TOKENS) -> DataFrame:
    """``(row, n_words, pos, token, from, near)`` of each place with a prefix token."""
    if tokens.count() <= sent:
        low = lambda c: F.greatest(c - window + 1, F.lit(0))
        chunks = listed(base.where("n_words > 0")).select("row", "n_words", F.explode(F.transform(
            F.sequence(F.lit(0), F.size("w") - 1, F.lit(CHUNK)), lambda c: F.struct(
                c.alias("c"), low(c).alias("low"),
                F.slice("w", low(c) + 1, c - low(c) + CHUNK + window - 1).alias("w")))).alias("k"))
        chunks = chunks.select("row", "n_words", "k.c", "k.low", "k.w")
        # the array goes along by reference; only matches look at what is around them
        p, low = F.col("c") + F.col("i"), F.col("low")
        first = F.greatest(p - window + 1, low)
        return chunks.select("*", F.posexplode(F.slice("w", F.col("c") - low + 1, CHUNK)).alias("i", "token")).join(
            F.broadcast(tokens), "token", "left_semi").select(
            "row", "n_words", p.alias("pos"), "token", first.alias("from"),
            F.slice("w", first - low + 1, p - first + window).alias("near"))
    places = listed(base).select("row", F.posexplode("w").alias("pos", "token")).join(
        tokens, "token", "left_semi").groupBy("row").agg(F.collect_list("pos").alias("places"))
    return listed(stored(places, "places").join(base.select("row", "w", "n_words"), "row")).select(
        "row", "n_words", F.explode(F.transform("places", lambda p: F.struct(
            p.alias("pos"), F.get("w", p).alias("token"), F.greatest(p - window + 1, F.lit(0)).alias("from"),
            F.slice("w", F.greatest(p - window + 2, F.lit(1)), F.least(p, F.lit(window - 1)) + window).alias("near")
        ))).alias("p")).select("row", "n_words", "p.*")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, sent: int = SENT_TOKENS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``item_ids`` (items with occurring windows, sorted as
    strings) and ``contaminated`` (``n_hit > 0 and 20 * n_hit >= n_words``).

    A text or item that is NULL or has no words matches nothing. Repeated rows are
    judged one by one, NULL ids included; repeated items count once; an item with a NULL
    id hits words but is not listed. Other columns are not looked at. No documents give
    no rows, no items give no hits."""
    base = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        words(F.col(text)).alias("w")).withColumn("n_words", F.size("w").cast("long")).withColumn(
        "w", F.array_join("w", " ")), "words")
    windows = stored(item_windows(items, item_id, item_text, window).withColumn(
        "wid", F.monotonically_increasing_id()), "windows")
    windows = stored(rarest(base, windows).coalesce(1), "windows")
    tokens = stored(windows.select("token").distinct().coalesce(1), "tokens")

    around = surroundings(base, tokens, window, sent)
    start, length = F.col("pos") - F.col("at"), F.size("win")
    found = around.join(windows, "token").where(
        (start >= 0) & (start + length <= F.col("n_words"))
        & (F.slice("near", start - F.col("from") + 1, length) == F.col("win"))
    ).groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct(start.alias("s"), (start + length).alias("e")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["end"], x["s"]))).alias("n"),
            F.greatest(a["end"], x["e"]).alias("end")), lambda a: a["n"])
    found = stored(found.select("row", covered.alias("n_hit"), "item_ids"), "found")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id", "n_words", hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"))


def op8_decontaminate(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), "
          f"'{UPPER}', '{LOWER}'), " r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

QUERIES = {"op8_decontaminate": op8_decontaminate}
ORACLES = {"op8_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     win AS (SELECT DISTINCT item_id, least(len(w), 13) AS l, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS win
             FROM i, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(s) WHERE len(w) > 0),
     lens AS (SELECT DISTINCT l FROM win),
     dw AS (SELECT doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') AS win
            FROM d, lens, unnest(range(1, len(w) - l + 2)) AS u(s)),
     hits AS (SELECT doc_id, s, l, item_id FROM dw JOIN win USING (l, win)),
     n AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT DISTINCT doc_id, s, l FROM hits), unnest(range(s, s + l)) AS u(p) GROUP BY doc_id),
     it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)"""}
