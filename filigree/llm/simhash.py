"""SimHash near-duplicates, found by pigeonring filtering.

The 64 bits of a fingerprint form a ring of 8 segments. If two fingerprints differ in
at most 3 bits, then by the pigeonring principle there is a segment from which every
chain of l segments differs in at most ``l * 3 / 8`` bits: the first 2 segments are
equal, the first 5 differ in at most 1 bit, the first 7 in at most 2. So each
fingerprint is filed under 16 keys: for each start, the 2 equal segments and one or
the other half of the 3 segments after them (24 bits with at most one difference have
an equal half). Fingerprints that share a key are compared chain by chain, and only
those within all budgets are compared in full.

A key with very many fingerprints is dealt out as pairs of blocks. Per key, a spanning
forest of the links is emitted, never all pairs; equal fingerprints are one node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.components import components
from filigree.llm.work import numbered, only, small_batches, stored, table

BITS, SEGMENTS, MAX_BITS = 64, 8, 3
WIDTH = BITS // SEGMENTS
#: Fingerprints of one key that one task compares with each other.
BLOCK = 8192
_ALL = (1 << BITS) - 1


def fingerprint(text: str | None, words: int = 3) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; 0 without words."""
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    elif words == 3:
        shingles = [b"%b %b %b" % s for s in zip(w, w[1:], w[2:], strict=False)]
    else:
        shingles = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)]
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, len(shingles), 4096):  # 4,096 hashes unpack to 256 KB
        h = np.array([digest(s, 42) for s in shingles[i:i + 4096]], dtype=">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 words: int = 3) -> DataFrame:
    """``(doc_id, fp)``, one row per row of ``docs``; ``fp`` is the unsigned fingerprint
    in the bits of a long. NULL and blank texts have fingerprint 0."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, fp long")


def _turned(fp: str, start: int):
    """The fingerprint with the given segment first."""
    k, v = start * WIDTH, F.col(fp)
    return v if k == 0 else F.shiftleft(v, k).bitwiseOR(F.shiftrightunsigned(v, BITS - k))


def keyed(nodes: DataFrame) -> DataFrame:
    """``(key, fp, rep)``: 16 rows per fingerprint. A key holds the start, the half and
    the 28 bits that have to be equal."""
    ways = []
    for start in range(SEGMENTS):
        t = _turned("fp", start)
        first = F.shiftrightunsigned(t, 48)
        for half in range(2):
            part = F.shiftrightunsigned(t, 36 if half == 0 else 24).bitwiseAND(F.lit(0xFFF))
            ways.append(F.lit((start * 2 + half) << 28).bitwiseOR(
                F.shiftleft(first, 12)).bitwiseOR(part))
    return nodes.select(F.explode(F.array(*ways)).alias("key"), "fp", "rep")


def _chains(start: int) -> list[tuple[np.uint64, int]]:
    """Masks of growing chains from a segment, each with the bits it may differ in."""
    out = []
    for length in range(1, SEGMENTS + 1):
        mask = ((1 << length * WIDTH) - 1) << (BITS - length * WIDTH)
        turn = start * WIDTH
        out.append((np.uint64((mask >> turn | mask << (BITS - turn)) & _ALL), length * MAX_BITS // SEGMENTS))
    return out


CHAINS = [_chains(s) for s in range(SEGMENTS)]


def _forest(fp: np.ndarray, rep: np.ndarray, start: int, out: list) -> None:
    """Links of a spanning forest of the fingerprints that share a key."""
    chains, left = CHAINS[start], np.arange(len(fp))
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            x, near = fp[left] ^ fp[at], np.arange(len(left))
            for mask, budget in chains[2:]:
                near = near[np.bitwise_count(x[near] & mask) <= budget]
                if not len(near):
                    break
            if len(near):
                found = left[near]
                out.extend((rep[at], rep[f]) for f in found)
                front.extend(found)
                left = np.delete(left, near)


def _links(batches):
    """Rows come sorted by key and block; a group may go over several batches."""
    held: list = []

    def emit(groups):
        out: list = []
        for key, fp, rep in groups:
            _forest(fp, rep, int(key) >> 29, out)
        a = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if held:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        key, pair, fp, rep = cols
        if not len(key):
            continue
        cut = np.flatnonzero((key[1:] != key[:-1]) | (pair[1:] != pair[:-1])) + 1
        last = cut[-1] if len(cut) else 0
        bounds = np.concatenate([[0], cut])
        sizes = np.diff(bounds)
        many = np.flatnonzero(sizes > 1)
        yield emit((key[bounds[i]], fp[bounds[i]:bounds[i + 1]].view(np.uint64),
                    rep[bounds[i]:bounds[i + 1]]) for i in many)
        held = [c[last:] for c in cols]
    if held and len(held[0]) > 1:
        yield emit([(held[0][0], held[2].view(np.uint64), held[3])])


def links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between ``rep`` values of ``nodes (fp, rep)``, enough of them to
    join whatever is within 3 bits. ``fp`` is distinct."""
    k = keyed(nodes)
    hot = k.groupBy("key").count().where(F.col("count") > block).select(
        "key", F.ceil(F.col("count") / block).cast("int").alias("n"))
    n = F.coalesce("n", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    pairs = F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), n - 1),
                    lambda j: F.least(own, j) * n + F.greatest(own, j)))
    dealt = k.join(hot, "key", "left").select("key", F.explode(pairs).alias("pair"), "fp", "rep")
    # two blocks meet in one group, so a pair of rows of one block meets in several
    return dealt.repartition("key", "pair").sortWithinPartitions("key", "pair").mapInArrow(
        _links, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` (long) and ``component_id``, the
    smallest id reachable over fingerprints that differ in at most 3 bits.

    NULL, empty and blank texts have fingerprint 0 and are linked like any other. Rows
    with a NULL id get the component of their fingerprint. Repeated rows give repeated
    results. Other columns of ``docs`` are not looked at. No rows give no rows."""
    fps = stored(fingerprints(docs, doc_id, text, words), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    comp = components(links(nodes.where("rep IS NOT NULL"), block))
    reps = nodes.join(comp, nodes.rep == comp.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(reps, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Exactly one row of each component of near-duplicates, all columns as they are: the
    one with the smallest id, of rows that share it any one; a row with a NULL id stays
    only where no row of its component has an id. No rows give no rows."""
    docs, row = numbered(docs)
    found = near_duplicates(docs, row, text, **how)
    ids = docs.select(F.col(row).alias("_number"), F.col(doc_id).cast("long").alias("_id"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_number"))
    kept = found.join(ids, F.col("doc_id") == F.col("_number")).groupBy("component_id").agg(
        first.alias("first")).select(F.col("first._number").alias("_kept"))
    return only(docs, row, kept)


def op3_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


QUERIES = {"op3_simhash": op3_simhash}
