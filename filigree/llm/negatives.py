"""Hard negatives by segment summary filtering.

Every vector is cut into segments, and each segment's mean and deviation are stored
with it. Of two segments of s components the inner product is s times the product of
the means, plus or minus at most s times the product of the deviations; summed over
the segments this bounds a score from both sides. Summaries of two neighbours give
that of their union, so one stored level gives all coarser ones: bounds are taken over
one segment, then two, four and so on, each time only for pairs that the level before
could not rule out. What is left is scored exactly, in whole numbers.

Anchors are a stated query set against all rows, in blocks: a group holds one block of
anchors and streams one block of rows past it, keeping the few best of each anchor. So
a hot label is many groups of bounded size. The work is (anchors x rows) bounds by
nature; nothing but the best few rows of an anchor leaves a group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.work import small_batches, stored, table

SEGMENTS = 8
#: Rows and anchors of one group, and of one matrix of bounds inside it.
ROWS, ANCHORS, CHUNK_ROWS, CHUNK_ANCHORS = 8192, 8192, 2048, 512
#: Pairs left at which the rest of a matrix is looked at one by one.
SPARSE = 0.04
EXACT = 2.0 ** 53
_MOST = 2 ** 63 - 1
_COLUMNS = "row long, vec_id long, label int, size int, most double, v binary, mean binary, dev binary"


# ---- summaries --------------------------------------------------------------------

def segment_sizes(size: int, segments: int = SEGMENTS) -> np.ndarray:
    return np.array([len(p) for p in np.array_split(np.arange(size), min(segments, max(size, 1)))])


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row."""
    edges = np.concatenate([[0], np.cumsum(segment_sizes(x.shape[1]))])
    parts = [x[:, a:b] if b > a else np.zeros((len(x), 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return np.stack([p.mean(1) for p in parts], 1), np.stack([p.std(1) for p in parts], 1)


def levels(mean: np.ndarray, dev: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From one segment to those stored: ``(a, b)`` per level, such that the scores of
    two rows lie within ``a1.a2 - b1.b2`` and ``a1.a2 + b1.b2``."""
    out = []
    while True:
        root = np.sqrt(sizes)
        out.append((mean * root, dev * root))
        if len(sizes) == 1:
            return out[::-1]
        at = np.arange(0, len(sizes), 2)
        total = np.add.reduceat(sizes, at)
        of = np.maximum(total, 1)
        both = np.add.reduceat(mean * sizes, at, axis=1) / of
        apart = mean - np.repeat(both, np.diff(np.append(at, len(sizes))), axis=1)
        dev = np.sqrt(np.add.reduceat((dev ** 2 + apart ** 2) * sizes, at, axis=1) / of)
        mean, sizes = both, total


def prepared(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """Rows that take part, numbered, each with its vector and its summaries."""
    small_batches(rows.sparkSession, 4096)
    kind = dict(rows.dtypes)[vector]
    values = vector if kind == "array<float>" else F.col(vector).cast("array<double>")

    def run(batches):
        for b in batches:
            col = b.column(3)
            size, start = np.diff(col.offsets.to_numpy()), col.offsets.to_numpy()[:-1]
            flat = col.values.to_numpy(zero_copy_only=False)  # a NULL component becomes nan
            for n in np.unique(size).tolist():
                at = np.flatnonzero(size == n)
                x = flat[start[at][:, None] + np.arange(n)]
                good = np.isfinite(x).all(1)
                at, x = pa.array(at[good]), x[good]
                with np.errstate(over="ignore", invalid="ignore"):
                    whole = np.floor(256 * x.astype(np.float64))
                    mean, dev = summaries(whole)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).take(at) for i in range(3)), pa.array(np.full(len(x), n, np.int32)),
                     pa.array(np.abs(whole).max(1, initial=0)),
                     *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (x, mean, dev))],
                    ["row", "vec_id", "label", "size", "most", "v", "mean", "dev"])

    return stored(rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("int").alias("label"), F.col(values).alias("v") if isinstance(values, str) else values.alias("v"))
        .where("label IS NOT NULL AND v IS NOT NULL").mapInArrow(run, _COLUMNS), "vectors")


# ---- one group ----------------------------------------------------------------------

class Block:
    """Some rows of one length, as matrices."""

    def __init__(self, rows: list[tuple]):
        # row, vec_id, label, size, most, v, mean, dev
        n, size = len(rows), rows[0][3]
        self.row = np.array([r[0] for r in rows], np.int64)
        self.id = np.array([_MOST if r[1] is None else r[1] for r in rows], np.int64)
        self.label = np.array([r[2] for r in rows], np.int64)
        self.most = max(r[4] for r in rows)
        raw = b"".join(r[5] for r in rows)
        kind = np.float32 if len(raw) == 4 * n * size else np.float64
        self.given = np.frombuffer(raw, kind).reshape(n, size).astype(np.float64)
        with np.errstate(over="ignore"):
            self.x = np.floor(256 * self.given)
        mean, dev = (np.frombuffer(b"".join(r[i] for r in rows)).reshape(n, -1) for i in (6, 7))
        with np.errstate(all="ignore"):
            self.levels = levels(mean, dev, segment_sizes(size).astype(np.float64))

    def integers(self) -> np.ndarray:
        """Components too large for exact sums of doubles."""
        return np.array([[int(w) if math.isfinite(w) else int(x) * 256 for w, x in zip(ws, xs, strict=True)]
                         for ws, xs in zip(self.x.tolist(), self.given.tolist(), strict=True)], object).reshape(self.x.shape)


def pairs_above(a: Block, part: slice, r: Block, allowed: np.ndarray, low: np.ndarray,
                high: np.ndarray | None, best: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, row, score)`` of allowed pairs whose score is at least ``low`` (and at
    most ``high``) of the anchor. With ``best``, pairs that can't be among that many
    best of their anchor may be left out too."""
    size = a.x.shape[1]
    with np.errstate(over="ignore"):
        limit = a.most * r.most * max(size, 1)
    if not limit < EXACT / 4:  # beyond exact doubles: whole numbers, as they are
        scores = np.array(a.integers()[part] @ r.integers().T, object).reshape(allowed.shape)
        scores = np.clip(scores, -_MOST, _MOST).astype(np.int64)
        who, at = np.nonzero(allowed)
        return who, at, scores[who, at]
    slack = 0.5 + limit * 1e-12
    left = allowed
    dense, who, at = True, None, None
    for (am, ad), (rm, rd) in zip(a.levels, r.levels, strict=True):
        am, ad = am[part], ad[part]
        if dense:
            middle, width = am @ rm.T, ad @ rd.T
            upper = middle + width
            if best:
                least = np.where(left, middle - width, -np.inf)
                if least.shape[1] >= best:  # as many rows score at least this much
                    low = np.maximum(low, np.partition(least, -best, axis=1)[:, -best] - slack)
            left = left & (upper >= (low - slack)[:, None])
            if high is not None:
                left &= middle - width <= (high + slack)[:, None]
            if np.count_nonzero(left) < SPARSE * left.size:
                dense = False
                who, at = np.nonzero(left)
        elif len(who):
            middle = np.einsum("ij,ij->i", am[who], rm[at])
            width = np.einsum("ij,ij->i", ad[who], rd[at])
            keep = middle + width >= low[who] - slack
            if high is not None:
                keep &= middle - width <= high[who] + slack
            who, at = who[keep], at[keep]
    if dense:
        scores = a.x[part] @ r.x.T
        left &= scores >= low[:, None]
        if high is not None:
            left &= scores <= high[:, None]
        who, at = np.nonzero(left)
        return who, at, scores[who, at].astype(np.int64)
    scores = np.concatenate([np.einsum("ij,ij->i", a.x[part][who[i:i + 65536]], r.x[at[i:i + 65536]])
                             for i in range(0, len(who), 65536)] or [np.zeros(0)])
    return who, at, scores.astype(np.int64)


class Best:
    """The first ``k`` rows of each of ``n`` lists: highest score, then smallest id."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.list, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))
        self.low = np.full(n, -np.inf)

    def add(self, who, score, ids, row) -> None:
        if not len(who):
            return
        lists, score, ids, row = (np.concatenate(x) for x in (
            (self.list, who), (self.score, score), (self.id, ids), (self.row, row)))
        order = np.lexsort((row, ids, -score, lists))
        lists = lists[order]
        first = np.searchsorted(lists, lists, "left")
        keep = np.arange(len(order)) - first < self.k
        order = order[keep]
        self.list, self.score, self.id, self.row = lists[keep], score[order], ids[order], row[order]
        full = np.searchsorted(self.list, np.arange(self.n), "right") - 1
        size = full - np.searchsorted(self.list, np.arange(self.n), "left") + 1
        self.low = np.where(size >= self.k, self.score[np.maximum(full, 0)].astype(np.float64), -np.inf)


def _groups(batches, keys: int):
    """``(anchors, blocks of rows)`` of each group; rows come sorted by the group's
    columns and ``side``. Both have to be used up in turn."""
    def rows():
        for b in batches:
            yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True)

    stream = rows()
    ahead = [next(stream, None)]
    while ahead[0] is not None:
        group = ahead[0][:keys]

        def take(side, group=group):
            while ahead[0] is not None and ahead[0][:keys] == group and ahead[0][keys] == side:
                yield ahead[0][keys + 1:]
                ahead[0] = next(stream, None)

        anchors = list(take(0))

        def blocks(take=take):
            held = []
            for r in take(1):
                held.append(r)
                if len(held) == CHUNK_ROWS:
                    yield Block(held)
                    held = []
            if held:
                yield Block(held)

        yield anchors, blocks()
        for _ in take(1):
            pass


def _positives(k: int):
    def run(batches):
        for anchors, blocks in _groups(batches, 4):
            if not anchors:
                continue
            a = Block(anchors)
            best = [Best(min(CHUNK_ANCHORS, len(a.row) - i), k) for i in range(0, len(a.row), CHUNK_ANCHORS)]
            for r in blocks:
                for i, b in enumerate(best):
                    part = slice(i * CHUNK_ANCHORS, i * CHUNK_ANCHORS + b.n)
                    allowed = a.row[part, None] != r.row[None]
                    who, at, score = pairs_above(a, part, r, allowed, b.low, None, k)
                    b.add(who, score, r.id[at], r.row[at])
            for i, b in enumerate(best):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.row[i * CHUNK_ANCHORS + b.list]), pa.array(b.score), pa.array(b.row)],
                    ["anchor", "score", "row"])
    return run


def _negatives(k: int):
    def run(batches):
        for anchors, blocks in _groups(batches, 3):
            if not anchors:
                continue
            a = Block(anchors)
            scores = [sorted(set(r[8])) for r in anchors]
            wide = max(map(len, scores))
            # no row lies in the bounds of a positive that scores below zero, or of none
            low = np.array([[-(-s // 2) if s >= 0 else 1 for s in x] + [1] * (wide - len(x)) for x in scores], np.int64)
            high = np.array([[95 * s // 100 if s >= 0 else 0 for s in x] + [0] * (wide - len(x)) for x in scores], np.int64)
            some = low <= high
            best = [[Best(min(CHUNK_ANCHORS, len(a.row) - i), k) for _ in range(wide)]
                    for i in range(0, len(a.row), CHUNK_ANCHORS)]
            for r in blocks:
                for i, bs in enumerate(best):
                    part = slice(i * CHUNK_ANCHORS, i * CHUNK_ANCHORS + bs[0].n)
                    own = np.where(some[part], np.maximum(low[part], np.stack([b.low for b in bs], 1)), np.inf)
                    top = np.where(some[part], high[part], -np.inf).max(1)
                    allowed = (a.label[part, None] != r.label[None]) & some[part].any(1)[:, None]
                    who, at, score = pairs_above(a, part, r, allowed, own.min(1), top, 0)
                    for j, b in enumerate(bs):
                        ok = (score >= own[who, j]) & (score <= high[part][who, j])
                        b.add(who[ok], score[ok], r.id[at[ok]], r.row[at[ok]])
            for i, bs in enumerate(best):
                for j, b in enumerate(bs):
                    at = i * CHUNK_ANCHORS + b.list
                    # the positive's score is told by its place among the anchor's
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.row[at]), pa.array([scores[p][j] for p in at.tolist()], pa.int64()),
                         pa.array(b.score), pa.array(b.row)], ["anchor", "positive_score", "score", "row"])
    return run


# ---- the operator ---------------------------------------------------------------------

def _first(df: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _met(anchors: DataFrame, rows: DataFrame, by: list[str], n_rows: int, n_anchors: int) -> DataFrame:
    """Blocks of anchors and rows that agree in ``by``, each pair of blocks a group."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") / n_rows).cast("int").alias("_nr")).join(
        anchors.groupBy(*by).agg(F.ceil(F.count("*") / n_anchors).cast("int").alias("_na")), by)
    groups = sizes.agg(F.sum(F.col("_nr").cast("long") * F.col("_na"))).first()[0] or 1

    def dealt(df, side, own, other):
        parts = {own: F.pmod(F.xxhash64("row"), F.col(f"_n{own}")).cast("int"),
                 other: F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1))}
        return df.join(sizes, by).select(
            *[F.col(c).alias(f"_{c}") for c in by], parts["a"].alias("_a"), parts["r"].alias("_r"),
            F.lit(side).alias("_side"), *df.columns)

    keys = [*[f"_{c}" for c in by], "_a", "_r"]
    both = dealt(anchors, 0, "a", "r").unionByName(
        dealt(rows, 1, "r", "a"), allowMissingColumns=True)
    return both.repartition(min(int(groups), 100_000), *keys).sortWithinPartitions(*keys, "_side")


def hard_negatives(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                   every: int = 50, positives: int = 5, negatives: int = 3,
                   n_rows: int = ROWS, n_anchors: int = ANCHORS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components x become floor(256 x); scores are inner products of these. Anchors are
    the rows whose id is divisible by ``every``; their positives the first ``positives``
    other rows of their label by score, then id; for each, ``rank`` counts the first
    ``negatives`` rows of other labels whose score is 50 % to 95 % of the positive's.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take no
    part. Vectors of different lengths have no score; empty ones score 0. A NULL id is
    no anchor and comes last of equals. Rows that share an id are rows of their own, so
    a repeated anchor gives its rows again. Scores beyond a long count as the largest
    long. Other columns are not looked at. No rows, or no anchors, give no rows."""
    base = prepared(rows, vec_id, vector, label)
    anchors = base.where(F.col("vec_id") % every == 0)
    name = base.select("row", "vec_id")

    found = _met(anchors, base, ["size", "label"], n_rows, n_anchors).mapInArrow(
        _positives(positives), "anchor long, score long, row long")
    chosen = stored(_first(found.join(name, "row"), positives, "anchor").select(
        "anchor", F.col("row").alias("p_row"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")

    scores = chosen.groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))  # five at most
    asking = anchors.join(scores, anchors["row"] == scores["anchor"]).drop("anchor")
    found = _met(asking, base, ["size"], n_rows, n_anchors).mapInArrow(
        _negatives(negatives), "anchor long, positive_score long, score long, row long")
    best = _first(found.join(name, "row"), negatives, "anchor", "positive_score").select(
        "anchor", "positive_score", "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    who = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return chosen.join(best, ["anchor", "positive_score"]).join(who, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score")


def op13_hardnegatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    # the contract's label noise: every seventh row is taken for the next label
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", noisy.cast("int").alias("label")))


QUERIES = {"op13_hardnegatives": op13_hardnegatives}

ORACLES = {"op13_hardnegatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_dot_product(a.x, r.x)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""}
