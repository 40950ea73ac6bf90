"""Spelling variants by search schemes on a bidirectional FM-index.

Two words one error apart agree exactly in the first half of either, or in the rest.
So each word is searched for twice: its first half is matched exactly and extended to
the right across the other half with one error allowed, and its second half is matched
and extended to the left in the same way. Extending to the right needs the index of
the reversed text, extending to the left that of the text; the two together are the
bidirectional index, and with one error no search ever turns round. A search holds an
interval of suffix ranks; a step narrows it by rank queries. Words stand between
delimiters, so an interval that takes in both delimiters is one word.

The vocabulary is kept in two orders, by word and by reversed word, each cut into
shards of bounded size by a range partition; a shard has an index of its own. The words
that begin with a half lie in one run of shards, mostly a single one, and its search
visits only these. A shard with many visitors is dealt out to several tasks.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.work import small_batches, stored, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Words of one shard, unless there are more than ``SHARDS`` times as many; visitors of
#: one task; words that search at a time.
WORDS, SHARDS, VISITORS, AT_ONCE = 32_768, 16_384, 65_536, 4096
#: Characters of a shard's lower bound that are compared.
BOUND = 64
#: Distinct words that a Python worker counts before it hands them on.
HELD = 200_000
_LAST = "\U0010ffff"


# ---- the vocabulary ---------------------------------------------------------------------

def without_one(who: str, run: str, every: int) -> str:
    """A run, or with the deletion that its checksum asks for."""
    h = zlib.crc32(run.encode(), zlib.crc32(who.encode() + b":"))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 31,
               shortest: int = 7, least: int = 2) -> DataFrame:
    """``(word, n)``: runs of letters after the deletions, lower-cased in A-Z only, of at
    least ``shortest`` code points and with at least ``least`` occurrences in all."""
    small_batches(docs.sparkSession)

    def run(batches):
        words: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for who, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not t:
                    continue
                start = zlib.crc32(b"%b:" % ("" if who is None else str(who)).encode())
                for w, n in Counter(RUN.findall(t.translate(_LOWER))).items():
                    if len(w) < shortest:
                        continue
                    if zlib.crc32(w.encode(), start) % every == 0:
                        w = without_one("" if who is None else str(who), w, every)
                        if len(w) < shortest:
                            continue
                    words[w] += n
                if len(words) >= HELD:
                    yield out()
                    words = Counter()
        if words:
            yield out()

    counted = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("string")).mapInArrow(
        run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- one shard's index --------------------------------------------------------------------

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of an array whose last value is its only smallest, by doubling."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.zeros(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], text[order][1:] != text[order][:-1]]))
    width = 1
    while rank[order[-1]] < n - 1:
        key = rank * (n + 1)
        key[:n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        width *= 2
    return order


class Index:
    """Of words read from left to right: intervals of the reversed text's suffixes are
    extended to the right of a pattern. Code 0 ends the text, 1 is the delimiter."""

    def __init__(self, words: list[str]):
        self.words = words
        joined = np.frombuffer("\n".join(["", *words, ""]).encode("utf-32-le"), np.uint32)
        letters, codes = np.unique(joined, return_inverse=True)
        # the line break sorts before all letters, so it has code 1
        self.letters = {int(c): i + 1 for i, c in enumerate(letters)}
        text = np.append(codes[::-1] + 1, 0)
        self.n, self.sigma = len(text), len(letters) + 1
        self.suffix = suffix_array(text)
        self.bwt = text[self.suffix - 1]
        by_code = np.argsort(self.bwt, kind="stable")
        # all places of all letters in one sorted array: a rank query is a binary search
        self.places = self.bwt[by_code] * (self.n + 1) + by_code
        self.first = np.searchsorted(self.places, np.arange(self.sigma + 1) * (self.n + 1))
        # where words begin in the text, told from its end
        self.starts = np.flatnonzero(joined == 10)[:-1] + 1

    def code(self, words: list[str]) -> np.ndarray:
        """Letters of words as codes, one after the other; 0 for one the text lacks."""
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        known, at = np.unique(flat, return_inverse=True)
        return np.array([self.letters.get(int(c), 0) for c in known] or [0], np.int64)[at] if len(flat) else flat.astype(np.int64)

    def step(self, code, low, high):
        """Intervals after one more letter; empty ones for letters the text lacks."""
        key = code * (self.n + 1)
        low, high = np.searchsorted(self.places, key + low), np.searchsorted(self.places, key + high)
        # suffixes are sorted by letter, so the rank among all places is the new suffix rank
        return low, np.where(code > 0, high, low)

    def following(self, low, high):
        """``(which interval, letter)``: every letter that may come next."""
        size, wide = high - low, self.sigma - 1
        few, many = np.flatnonzero(size < wide), np.flatnonzero(size >= wide)
        which = np.repeat(few, size[few])
        at = np.arange(len(which)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + low[which]
        seen = np.unique(which * self.sigma + self.bwt[at])
        every = np.repeat(many, wide) * self.sigma + np.tile(np.arange(1, self.sigma), len(many))
        both = np.concatenate([seen, every])
        return both // self.sigma, both % self.sigma

    def word(self, low):
        """Which word the one suffix of each interval stands for, its end delimiter
        being the last letter matched."""
        # the suffix of the reversed text begins at that delimiter
        end = self.n - 2 - self.suffix[low]
        return np.searchsorted(self.starts, end, "right") - 1

    def near(self, queries: list[str], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(query, word)``: each pair one error apart that agrees in the query's first
        ``halves`` letters, once."""
        size = np.array([len(q) for q in queries])
        # letters of the query behind a delimiter and before one
        codes = self.code(queries)
        flat = np.ones(len(codes) + 2 * len(queries), np.int64)
        base = np.cumsum(size + 2) - size - 2
        inner = np.ones(len(flat), bool)
        inner[base] = inner[base + size + 1] = False
        flat[inner] = codes
        who = np.arange(len(queries))
        low, high = self.step(np.ones(len(queries), np.int64), np.zeros(len(queries), np.int64),
                              np.full(len(queries), self.n))
        active, at = np.ones(len(queries), bool), 1
        found = []
        # branches behind the error: query, place of the next letter, interval
        branch = [np.zeros(0, np.int64) for _ in range(4)]
        while len(who) or len(branch[0]):
            if len(branch[0]):
                q, p, lo, hi = branch
                lo, hi = self.step(flat[base[q] + p], lo, hi)
                alive, p = hi > lo, p + 1
                over = alive & (p == size[q] + 2)
                if over.any():
                    found.append((q[over], self.word(lo[over])))
                go = alive & ~over
                branch = [q[go], p[go], lo[go], hi[go]]
            if len(who):
                # errors at this place: another letter here, one too many before it, or this one left out
                free = who[at > halves[who]]
                at_end = size[free] + 1 == at
                i = np.searchsorted(who, free)
                lo, hi = low[i], high[i]
                new = []
                k, c = self.following(lo, hi)
                put = c > 1  # a delimiter is never an error
                k, c = k[put], c[put]
                l2, h2 = self.step(c, lo[k], hi[k])
                ok = h2 > l2
                k, c, l2, h2 = k[ok], c[ok], l2[ok], h2[ok]
                new.append((free[k], np.full(len(k), at), l2, h2))  # inserted before this letter
                sub = ~at_end[k] & (c != flat[base[free[k]] + at])
                new.append((free[k[sub]], np.full(sub.sum(), at + 1), l2[sub], h2[sub]))
                drop = ~at_end
                new.append((free[drop], np.full(drop.sum(), at + 1), lo[drop], hi[drop]))
                branch = [np.concatenate([b, *(x[j] for x in new)]) for j, b in enumerate(branch)]
                # without an error so far: the next letter has to match
                go = at <= size[who]
                who, low, high = who[go], low[go], high[go]
                low, high = self.step(flat[base[who] + at], low, high)
                go = high > low
                who, low, high = who[go], low[go], high[go]
                at += 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, w = (np.concatenate(x) for x in zip(*found, strict=True))
        both = np.unique(q * len(self.words) + w)
        return both // len(self.words), both % len(self.words)


# ---- search over shards -----------------------------------------------------------------

def _searches(forward: bool):
    """Best and number of the near words of each visitor, shard by shard. Rows come
    sorted by group and side: words first, then visitors."""
    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(5)), strict=True)

        def searched(index, n, visitors):
            text = [v[0] if forward else v[0][::-1] for v in visitors]
            size = np.array([len(t) for t in text])
            first = size // 2
            halves = first if forward else size - first
            q, w = index.near(text, halves)
            if not forward and len(q):  # the other search finds words that begin with the first half
                seen = np.array([index.words[j][::-1].startswith(visitors[i][0][:first[i]])
                                 for i, j in zip(q.tolist(), w.tolist(), strict=True)])
                q, w = q[~seen], w[~seen]
            out = {}
            for i, j in zip(q.tolist(), w.tolist(), strict=True):
                word = index.words[j] if forward else index.words[j][::-1]
                count, best = out.get(i, (0, None))
                mine = (-n[j], word)
                out[i] = (count + 1, mine if best is None or mine < best else best)
            return pa.RecordBatch.from_arrays(
                [pa.array([visitors[i][0] for i in out], pa.string()),
                 pa.array([c for c, _ in out.values()], pa.int64()),
                 pa.array([b[1] for _, b in out.values()], pa.string()),
                 pa.array([-b[0] for _, b in out.values()], pa.int64())], ["word", "n_near", "best", "best_n"])

        group, words, n, index, visitors = None, [], [], None, []
        for shard, side, part, word, count in rows():
            if (shard, part) != group:
                if visitors:
                    yield searched(index, n, visitors)
                group, words, n, index, visitors = (shard, part), [], [], None, []
            if side == 0:
                words.append(word if forward else word[::-1])
                n.append(count)
                continue
            if not words:
                continue
            if index is None:
                index = Index(words)
            visitors.append((word, count))
            if len(visitors) == AT_ONCE:
                yield searched(index, n, visitors)
                visitors = []
        if visitors:
            yield searched(index, n, visitors)
    return run


def searched(words: DataFrame, forward: bool, size: int, visitors: int = VISITORS) -> DataFrame:
    """``(word, n_near, best, best_n)`` per word and shard with near words that agree in
    the first half (``forward``) or else in the rest. ``words`` is ``(word, n)``."""
    key = F.col("word") if forward else F.reverse("word")
    total = words.count()
    shards = min(SHARDS, -(-total // size)) or 1
    filed = stored(words.repartitionByRange(shards, key).select(
        "word", "n", F.spark_partition_id().alias("shard")), "shards")
    bounds = filed.groupBy("shard").agg(F.substring(F.min(key), 1, BOUND).alias("low"),
                                        F.count("*").alias("n")).orderBy("shard").collect()  # SHARDS rows at most
    low, number = [r.low for r in bounds], [r.shard for r in bounds]

    def visits(batches):
        for b in batches:
            who, shard = [], []
            for i, w in enumerate(b.column(0).to_pylist()):
                half = w[:len(w) // 2] if forward else w[len(w) // 2:][::-1]
                a = max(0, bisect_left(low, half[:BOUND]) - 1)
                z = bisect_right(low, half + _LAST)
                who.extend([i] * (z - a))
                shard.extend(number[a:z])
            at = pa.array(who, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(shard, pa.int32())], ["word", "n", "shard"])

    asked = stored(words.mapInArrow(visits, "word string, n long, shard int"), "visits")
    # a shard whose words share a short half has many visitors: its index goes to several tasks
    parts = asked.groupBy("shard").agg(F.ceil(F.count("*") / visitors).cast("int").alias("parts"))
    index = filed.join(parts, "shard").select(
        "shard", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "word", "n")
    asked = asked.join(parts, "shard").select(
        "shard", F.lit(1).alias("side"), F.pmod(F.xxhash64("word"), "parts").cast("int").alias("part"), "word", "n")
    groups = parts.agg(F.sum("parts")).first()[0] or 1
    return index.unionByName(asked).repartition(int(min(groups, 100_000)), "shard", "part").sortWithinPartitions(
        "shard", "part", "side").mapInArrow(_searches(forward), "word string, n_near long, best string, best_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, form, root)`` of ``(word, form)``, words distinct: the last form that
    following forms leads to. Each round doubles the way, and a way is short: every form
    is more frequent than its word by the given factor."""
    way = stored(forms.withColumn("root", F.col("form")), "roots")
    while True:
        on = way.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        if way.join(on, F.col("root") == F.col("_at"), "left_semi").isEmpty():
            return way
        way = stored(way.join(on, F.col("root") == F.col("_at"), "left").select(
            "word", "form", F.coalesce("_to", "root").alias("root")), "roots")


def variants(words: DataFrame, factor: int = 10, size: int = WORDS, visitors: int = VISITORS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of distinct words ``(word, n)`` of at
    least two letters. ``n_near`` counts the words one inserted, deleted or replaced code
    point away; ``form`` is the most frequent of them (the smallest of equals) if it is
    at least ``factor`` times as frequent, else NULL; ``root`` is where following forms
    ends. Words neither contain line breaks nor are NULL. No words give no rows."""
    words = stored(words.select("word", "n"), "words")
    both = [searched(words, forward, size, visitors) for forward in (True, False)]
    first = F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))
    near = both[0].unionByName(both[1]).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(first).alias("best"))
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.m") >= factor * F.col("n"), F.col("best")).alias("best")), "near")
    found = found.select("word", "n", "n_near", F.col("best.w").alias("form"), (-F.col("best.m")).alias("form_n"))
    ends = roots(found.where("form IS NOT NULL").select("word", "form")).select("word", "root")
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``variants`` of the ``vocabulary`` of ``docs``.

    NULL, empty and letterless texts have no words. A NULL id counts as an empty one in
    the checksums, and rows are read one by one, so repeated rows count again. Other
    columns are not looked at. No rows give no rows."""
    return variants(vocabulary(docs, doc_id, text), **how)


def op11_spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {"op11_spelling": op11_spelling}
