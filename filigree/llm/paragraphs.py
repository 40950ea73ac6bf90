"""Substring dedup by MinHash banding of paragraphs.

A paragraph is a line of at least ``MIN_WORDS`` words. Equal paragraphs (of the same
lower-cased words) are one class. Classes have a MinHash of 64 values over their 5-word
shingles, in 16 bands of 4: classes of Jaccard similarity 0.8 share a band with
probability 0.9998. Classes that share a band meet, and their exact Jaccard similarity
decides. A band with very many classes is dealt out as pairs of blocks, and what leaves
it is a spanning forest of the verified links, never all pairs. Of each component of
linked classes the first paragraph (by document id and place) stays, all others go.

A passage may also repeat inside longer, differing paragraphs, or run over short lines.
So texts are cut into passages as well, whatever their lines: borders are the places
where the hash of two words is the least of ``SPAN`` neighbours, and a passage runs from
a border to the first one at least ``MIN_WORDS`` words on. Which borders there are
depends on the words around them only, so any two runs of 64 equal words (3 * (SPAN - 1) +
MIN_WORDS + 2) share at least one passage, and hardly any two of 50 do not. Passages are compared by hash; all but the
first of equal ones go. Spans that touch or overlap are reported as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.components import components
from filigree.llm.work import bit_is_set, bitmaps, numbered, small_batches, stored, table

MIN_WORDS, SHINGLE, SIMILARITY, BANDS, ROWS, BLOCK = 20, 5, 0.8, 16, 4, 1000
#: Neighbours among which a border of a passage is the least.
SPAN = 15
#: Words whose hashes a Python worker remembers; shingles whose MinHash is taken at once.
REMEMBERED, AT_ONCE = 500_000, 1024
#: Bits of the set that tells which hashes may repeat.
SET_BITS = 1 << 25
_rng = np.random.default_rng(11)
FACTORS = _rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
SHIFTS = _rng.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_BLANKS = np.zeros(0x3002, bool)
_BLANKS[[*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]] = True
_hashes: dict[str, int] = {}
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    found = list(map(_hashes.get, words))
    k = -1
    for _ in range(found.count(None)):
        k = found.index(None, k + 1)
        found[k] = _hashes[words[k]] = xxhash.xxh64_intdigest(words[k])
    return np.array(found, np.uint64)


def _mixed(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    size = len(hashes) - n + 1
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = (total ^ hashes[k:k + size]) * np.uint64(_BASE)
        total ^= total >> np.uint64(29)
    return total


def shingles(words: list[str]) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of five words, or of all words if fewer."""
    return np.unique(_mixed(word_hashes(words), min(SHINGLE, len(words))))


def band_keys(sh: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A key per band, different bands never having equal ones, of each of the sets that
    begin at ``starts`` in ``sh``; none is empty."""
    least = np.full((len(starts), BANDS * ROWS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(sh), AT_ONCE):
        x = np.multiply(sh[k:k + AT_ONCE, None], FACTORS)
        x += SHIFTS
        x ^= np.right_shift(x, np.uint64(31))
        first = np.searchsorted(starts, k, "right") - 1
        last = np.searchsorted(starts, k + len(x), "left")
        cut = np.maximum(starts[first:last] - k, 0)
        least[first:last] = np.minimum(least[first:last], np.minimum.reduceat(x, cut, axis=0))
    key = np.zeros((len(starts), BANDS), np.uint64)
    for k in range(ROWS):
        key = (key ^ least[:, k::ROWS]) * np.uint64(0xC2B2AE3D27D4EB4F)
        key ^= key >> np.uint64(32)
    return (key << np.uint64(4) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _over(x: np.ndarray, span: int, best) -> np.ndarray:
    """``best`` of each window of ``span`` values."""
    wide = 1
    while 2 * wide <= span:
        x, wide = best(x[:-wide], x[wide:]), 2 * wide
    return best(x[:len(x) - (span - wide)], x[span - wide:]) if wide < span else x


def passages(hashes: np.ndarray, min_words: int = MIN_WORDS, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word behind the last, and hash of each passage."""
    none = np.zeros(0, np.int64)
    if len(hashes) < min_words + 2:
        return none, none, none
    two = _mixed(hashes, 2)
    span = min(span, len(two))
    # places that are the least of some window that they are in
    least = np.pad(_over(two, span, np.minimum), span - 1)
    border = np.flatnonzero(_over(least, span, np.maximum) == two)
    end = np.searchsorted(border, border + min_words)
    start, end = border[end < len(border)], border[end[end < len(border)]]
    size = 1 << int(len(hashes)).bit_length()
    if size not in _powers:
        if len(_powers) > 24:
            _powers.clear()
        _powers[size] = tuple(np.multiply.accumulate(np.concatenate([
            np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_BASE, _BACK))
    up, down = _powers[size]
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)], dtype=np.uint64)])
    return start, end, ((upto[end] - upto[start]) * down[start]).view(np.int64)


def _places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word in code points, as ``str.split`` takes words."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = ~_BLANKS[np.minimum(code, len(_BLANKS) - 1)]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_DOC = ("doc_id long, row long, pos array<int>, start array<int>, end array<int>, hash array<binary>, words array<string>, "
        "keys array<long>, p_start array<int>, p_end array<int>, p_hash array<long>")


def analysed(docs: DataFrame, doc_id: str, text: str, min_words: int, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: its paragraphs (place, span, hash, lower-cased words,
    band keys, ``BANDS`` each) and its passages (span, hash)."""
    import xxhash

    small_batches(docs.sparkSession)

    min_words = max(min_words, SHINGLE)

    def listed(counts, values):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(2).to_pylist()]
            words = [t.lower().split() for t in texts]
            hashes = word_hashes([w for own in words for w in own])
            size = np.array([len(w) for w in words])
            before, places = np.cumsum(size) - size, [_places(t) for t in texts]
            # paragraphs: document, line, span, hash, words; first word in the batch, shingles
            paras, first, count = [], [], []
            for k, (t, own) in enumerate(zip(texts, words, strict=True)):
                lines = t.split("\n")
                ends = np.cumsum([len(x) + 1 for x in lines])
                upto = np.searchsorted(places[k][0], ends - 1).tolist()
                word = at = 0
                for pos, (line, end, last) in enumerate(zip(lines, ends.tolist(), upto, strict=True)):
                    if last - word >= min_words:
                        joined = " ".join(own[word:last])
                        paras.append((k, pos, at, at + len(line), xxhash.xxh3_128_digest(joined), joined))
                        first.append(int(before[k]) + word)
                        count.append(last - word - SHINGLE + 1)
                    word, at = last, end
            keys = np.zeros(0, np.int64)
            if paras:
                count = np.array(count)
                start = np.cumsum(count) - count
                place = np.arange(count.sum()) - np.repeat(start - np.array(first), count)
                keys = band_keys(_mixed(hashes, SHINGLE)[place], start).ravel()
            per = np.bincount([p[0] for p in paras], minlength=len(texts)) if paras else np.zeros(len(texts), int)
            a, z, h = passages(hashes)
            doc = np.repeat(np.arange(len(texts)), size)
            inside = doc[a] == doc[z - 1] if len(a) else np.zeros(0, bool)
            a, z, h = a[inside], z[inside], h[inside]
            some = np.bincount(doc[a], minlength=len(texts)) if len(a) else np.zeros(len(texts), int)
            begin, end = (np.concatenate([x[i] for x in places]) for i in (0, 1))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(listed(per, pa.array([p[i + 1] for p in paras], t)) for i, t in enumerate(kinds)),
                 listed(per * BANDS, pa.array(keys)), listed(some, pa.array(begin[a], pa.int32())),
                 listed(some, pa.array(end[z - 1] if len(z) else z, pa.int32())), listed(some, pa.array(h))],
                [f.split()[0] for f in _DOC.split(", ")])

    number = F.monotonically_increasing_id() if row is None else F.col(row)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), number.alias("row"),
                       F.col(text).cast("string")).mapInArrow(run, _DOC)


def _may_repeat(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs more than once, and few others: a set of bits of fixed
    size (4 MB) of the repeated keys goes to all tasks, so the rest is never shuffled."""
    twice = rows.groupBy(key).count().where("count > 1")
    place = F.pmod(F.xxhash64(key), F.lit(SET_BITS))
    bits = bitmaps(twice.select(place))
    placed = rows.withColumn("_place", place).withColumn("block", F.shiftright("_place", 15))
    return placed.join(F.broadcast(bits), "block").where(bit_is_set(F.col("bits"), F.col("_place"))).select(*rows.columns)


# ---- near paragraphs -----------------------------------------------------------------

def _verified(similarity: float):
    """Spanning forests of groups that come sorted by band and pair of blocks."""
    def forest(rows, out):
        sets = [shingles(r[3].split(" ")) for r in rows]
        if len(rows) == 2:  # most are
            a, b = sets
            both = len(np.intersect1d(a, b, assume_unique=True))
            if both and both >= similarity * (len(a) + len(b) - both) - 1e-9:
                out.append((rows[0][2], rows[1][2]))
            return
        size = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        left = np.ones(len(sets), bool)
        for seed in range(len(sets)):
            if not left[seed]:
                continue
            left[seed], front = False, [seed]
            while front and left.any():
                at = front.pop()
                use = left[owner]
                flat, owner = flat[use], owner[use]
                both = np.bincount(owner[np.isin(flat, sets[at])], minlength=len(sets))
                near = np.flatnonzero(left & (both >= similarity * (size + size[at] - both) - 1e-9) & (both > 0))
                left[near] = False
                front.extend(near.tolist())
                out.extend((rows[at][2], rows[k][2]) for k in near)

    def run(batches):
        held, name, out = [], None, []
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if row[:2] != name:
                    if len(held) > 1:
                        forest(held, out)
                    held, name = [], row[:2]
                held.append(row)
            a = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])
            out = []
        if len(held) > 1:
            forest(held, out)
            a = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

    return run


def distinct_groups(met: DataFrame) -> DataFrame:
    """``met (key, pair, cid)`` with one of the groups that hold the same classes: like
    paragraphs share most of their bands, and one comparison tells. Lone classes go. The
    classes of a key are dealt by blocks, so a group holds those of two at most."""
    groups = met.groupBy("key", "pair").agg(F.array_sort(F.collect_list("cid")).alias("cids")).where(F.size("cids") > 1)
    one = groups.groupBy("cids").agg(F.min(F.struct("key", "pair")).alias("at"))
    return one.select("at.key", "at.pair", F.explode("cids").alias("cid"))


def near_paragraphs(base: DataFrame, similarity: float, block: int) -> DataFrame:
    """``(row, start, end)`` of paragraphs that an earlier one repeats."""
    paras = base.select("doc_id", "row", F.posexplode(F.arrays_zip("pos", "start", "end", "hash")).alias("nth", "p")).select(
        "doc_id", "row", "nth", "p.*")
    keyed = base.select("doc_id", "row", F.posexplode(F.arrays_zip("hash", "pos")).alias("nth", "p"), "keys").select(
        F.struct("doc_id", "row", "p.pos", "nth").alias("place"), "p.hash",
        F.slice("keys", F.col("nth") * BANDS + 1, F.lit(BANDS)).alias("keys"))
    # the band keys of equal paragraphs are equal
    classes = stored(keyed.groupBy("hash").agg(F.min("place").alias("first"), F.first("keys").alias("keys")).withColumn(
        "cid", F.monotonically_increasing_id()), "classes")
    keys = stored(_may_repeat(classes.select(F.explode("keys").alias("key"), "cid"), "key"), "keys")
    size = keys.groupBy("key").count().where("count > 1").select(
        "key", F.ceil(F.col("count") / block).cast("int").alias("n"))
    met = keys.join(size, "key")
    own = F.pmod(F.xxhash64("cid"), F.col("n")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                        lambda j: F.least(own, j) * F.col("n") + F.greatest(own, j))
    met = stored(distinct_groups(stored(met.select("key", F.explode(pairs).alias("pair"), "cid"), "met")), "groups")
    # the words of a class are those of its first paragraph
    asked = met.select("cid").distinct().join(classes.select("cid", "first.row", "first.nth"), "cid")
    words = base.select("row", F.posexplode("words").alias("nth", "words"))
    texts = asked.join(words, ["row", "nth"]).select("cid", "words")
    links = met.join(texts, "cid").select("key", "pair", "cid", "words").repartition("key", "pair").sortWithinPartitions(
        "key", "pair").mapInArrow(_verified(similarity), "a long, b long")
    comp = components(links)
    linked = stored(classes.select("hash", "first", "cid").join(comp, F.col("cid") == F.col("node"), "left").select(
        "hash", "first", F.coalesce("component", "cid").alias("component")), "linked")
    first = linked.groupBy("component").agg(F.min("first").alias("kept"), F.count("*").alias("_classes"))
    kept = linked.join(first, "component").select("hash", "kept")
    gone = (F.col("kept.row") != F.col("row")) | (F.col("kept.pos") != F.col("pos"))
    return paras.join(kept, "hash").where(gone).select("row", "start", "end")


def equal_passages(base: DataFrame) -> DataFrame:
    """``(row, start, end)`` of passages that an earlier one repeats."""
    each = base.select("doc_id", "row", F.explode(F.arrays_zip("p_start", "p_end", "p_hash")).alias("p")).select(
        "doc_id", "row", F.col("p.p_start").alias("start"), F.col("p.p_end").alias("end"), F.col("p.p_hash").alias("hash"))
    some = stored(_may_repeat(each, "hash"), "passages")
    first = some.groupBy("hash").agg(F.min(F.struct("doc_id", "row", "start", "end")).alias("kept"), F.count("*").alias("n"))
    # in one text ("a a a a") a passage may overlap the one that it repeats
    return some.join(first.where("n > 1"), "hash").where(
        (F.col("kept.row") != F.col("row")) | (F.col("kept.end") <= F.col("start"))).select("row", "start", "end")


def _merged(spans) -> F:
    """Sorted spans with those that touch or overlap made one."""
    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), lambda a, s: F.when(
        (F.size(a) > 0) & (s["start"] <= F.try_element_at(a, F.lit(-1))["end"]), F.concat(
            F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
                F.try_element_at(a, F.lit(-1))["start"].alias("start"),
                F.greatest(F.try_element_at(a, F.lit(-1))["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(a, F.array(s))))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
            similarity: float = SIMILARITY, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``removed`` (array of ``(start, end)`` in
    code points, of the paragraphs and passages that earlier ones repeat, sorted, those
    that touch made one), ``n_paragraphs`` (lines long enough to count) and ``row``, a
    number of the row (the column named so, if given: distinct, and equal in every reading).

    NULL, empty and blank texts have no paragraphs. Rows with a NULL id come first; rows
    that share an id are taken in the order they are read, so a repeated row loses its
    paragraphs. Other columns, whatever their names, are not looked at. No rows give no
    rows."""
    base = stored(analysed(docs, doc_id, text, min_words, row), "analysed")
    gone = near_paragraphs(base, similarity, block).unionByName(equal_passages(base))
    spans = gone.distinct().groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    spans = spans.select("row", _merged("spans").alias("removed"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return base.select("doc_id", "row", F.size("pos").cast("long").alias("n_paragraphs")).join(
        spans, "row", "left").select("doc_id", F.coalesce("removed", none).alias("removed"), "n_paragraphs", "row")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without spans; where whole lines go, so do their breaks."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        whole = (start == 0 or text[start - 1] == "\n") and (end == len(text) or text[end] == "\n")
        at = end + 1 if whole and end < len(text) else end
        if whole and end == len(text) and out and out[-1].endswith("\n"):
            out[-1] = out[-1][:-1]
    return "".join([*out, text[at:]])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with the repeated paragraphs and passages of ``text`` taken out; a NULL
    text stays NULL. Columns and their order stay."""
    names = docs.columns
    docs, number = numbered(docs)
    found = stored(repeats(docs, doc_id, text, row=number, **how).where(F.size("removed") > 0).select(
        F.col("row").alias("_found"), "removed"), "removed")
    rows = docs.join(found, docs[number] == found["_found"], "left").select(
        F.struct(*[docs[c] for c in names]).alias("doc"), "removed")

    @F.pandas_udf("string")
    def rest(texts, spans):
        return texts.combine(spans, lambda t, s: t if t is None or s is None else cut(
            t, [(int(x["start"]), int(x["end"])) for x in s]))

    return rows.withColumn("new", rest(F.col(f"doc.`{text}`").cast("string"), "removed")).select(
        *(F.col("new" if c == text else f"doc.`{c}`").alias(c) for c in names))


def op6_paragraphs(spark, sf_dir):
    found = repeats(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", F.size("removed").cast("long").alias("n_removed"), spans.alias("removed"), "n_paragraphs")


QUERIES = {"op6_paragraphs": op6_paragraphs}
