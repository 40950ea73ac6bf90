"""Token counts without token ids: pieces of distinct pre-tokens, times frequencies.

No piece of the vocabulary reaches across a border between pre-tokens, so the pieces
of a text are those of its pre-tokens. Documents are read in blocks; a block holds each
of its pre-tokens once and, per document, their numbers and frequencies. The pre-tokens
of all blocks meet by hash, where the pieces of each are counted once, and the counts
go back to the blocks that hold them: the most common word takes part once per block,
not once per occurrence or document. What travels is packed, one row per block and hash
part. Per document, frequencies times counts are summed; no ids are ever made of a text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.work import small_batches, stored, table

#: Characters and documents of one block; a longer text goes over several.
BLOCK, DOCUMENTS = 4_000_000, 8192
#: Hash parts of a block's pre-tokens (as many as the input has splits, within these);
#: pre-tokens of one part that are remembered.
LEAST_PARTS, MOST_PARTS, REMEMBERED = 96, 4096, 1_000_000
#: Longer pre-tokens are cut wherever two neighbours stand together in no piece.
LONG = 256
BLANK = "▁"
#: A word with the blanks before it, a line break, blanks that end a line or text.
_UNITS = re.compile(r" *[^ \n]+|\n| +")
#: A pre-token begins at the first blank behind anything else.
_BORDER = re.compile(r"(?<=[^ ]) ")


class Counts:
    """Piece counts by the library of the model."""

    def __init__(self, name: str):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self.sp = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())
                  if not (self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unknown(i))]
        self.pairs = {p[i:i + 2].replace(BLANK, " ") for p in pieces for i in range(len(p) - 1)}
        # pre-tokens are no more than words because no piece reaches over these borders
        assert not any("\n" in p or BLANK in p.lstrip(BLANK) for p in pieces)
        self.lead = len(self.sp.encode("\n"))

    def units(self, text: str) -> list[str]:
        """Pre-tokens of a text whose first pre-token has its blank."""
        found = _UNITS.findall(text)
        if max(map(len, found), default=0) <= LONG:
            return found
        return [p for u in found for p in ([u] if len(u) <= LONG else self.cut(u))]

    def cut(self, unit: str) -> list[str]:
        out, start, pairs = [], 0, self.pairs
        for i in range(1, len(unit)):
            if unit[i - 1:i + 1] not in pairs:
                out.append(unit[start:i])
                start = i
        return [*out, unit[start:]]

    def pieces(self, units: list[str]) -> list[int]:
        # behind a line break, which no piece holds, the library adds no blank of its own
        return [len(x) - self.lead for x in self.sp.encode(["\n" + u for u in units], num_threads=1)]


_COUNTS: dict[str, Counts] = {}


def counts(name: str) -> Counts:
    """One per Python worker."""
    if name not in _COUNTS:
        _COUNTS[name] = Counts(name)
    return _COUNTS[name]


def parts(text: str, size: int):
    """The text in parts of about ``size`` characters, cut where a pre-token begins."""
    start = 0
    while len(text) - start > size:
        border = _BORDER.search(text, start + size)
        if not border:
            break
        yield text[start:border.start()]
        start = border.start()
    yield text[start:]


_BLOCK_SCHEMA = ("block long, words array<binary>, row array<long>, doc_id array<long>, "
                 "n_bytes array<long>, size array<int>, code binary, freq binary")


def _short(numbers: np.ndarray) -> bytes:
    """Numbers of 0 and more, mostly small: one byte each, behind one of 255 for each 255."""
    whole, rest = np.divmod(numbers, 255)
    out = np.full(len(numbers) + int(whole.sum()), 255, np.uint8)
    out[np.cumsum(whole + 1) - 1] = rest
    return zstandard.ZstdCompressor().compress(out.tobytes())


def _long(raw: bytes) -> np.ndarray:
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.diff(np.cumsum(x, dtype=np.int64)[x != 255], prepend=0)


def blocks(docs: DataFrame, name: str, doc_id: str, text: str, block: int = BLOCK) -> DataFrame:
    """One row per block. ``words`` are its pre-tokens in parts by hash, joined by line
    breaks (the pre-token that is one stands as nothing) and compressed.
    ``code`` are the places of each document's pre-tokens among all of them, sorted, as
    distances, ``size`` of each document; ``freq`` their frequencies less one."""
    small_batches(docs.sparkSession)
    n_parts = max(LEAST_PARTS, min(MOST_PARTS, docs.rdd.getNumPartitions()))

    def run(batches):
        from pyspark import TaskContext

        c, number = counts(name), TaskContext.get().partitionId() << 32
        known: dict[str, int] = {}
        rows: list[tuple] = []
        code: list[list] = []
        freq: list[list] = []
        held = 0

        def one():
            parts: list[list] = [[] for _ in range(n_parts)]
            for u in sorted(known):  # words with a beginning in common compress well
                parts[zlib.crc32(u.encode()) % n_parts].append(u)
            place = np.zeros(len(known), np.int64)
            place[[known[u] for p in parts for u in p]] = np.arange(len(known))
            press = zstandard.ZstdCompressor().compress
            words = pa.array([press("\n".join("" if u == "\n" else u for u in p).encode()) if p else None for p in parts], pa.binary())
            size = np.array([len(x) for x in code])
            flat = place[np.array([k for x in code for k in x], np.int64)]
            own = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((flat, own))
            flat = flat[order]
            gaps = np.diff(flat, prepend=-1) - 1
            first = (np.cumsum(size) - size)[size > 0]
            gaps[first] = flat[first]
            times = np.array([n for x in freq for n in x], np.int64)[order] - 1
            cells = [words, *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)), pa.array(size, pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in cells),
                 pa.array([_short(gaps)], pa.binary()), pa.array([_short(times)], pa.binary())],
                [f.split()[0] for f in _BLOCK_SCHEMA.split(", ")])

        for b in batches:
            for row, who, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                whole = " " + t.replace(BLANK, " ") if t else ""
                n_bytes = len(t.encode()) if t else 0
                for part in parts(whole, block):
                    found = Counter(c.units(part))
                    code.append([known.setdefault(u, len(known)) for u in found])
                    freq.append(list(found.values()))
                    rows.append((row, who, n_bytes))
                    n_bytes, held = 0, held + len(part)
                    if held >= block or len(rows) >= DOCUMENTS:
                        yield one()
                        known, rows, code, freq, held, number = {}, [], [], [], 0, number + 1
        if rows:
            yield one()

    return docs.select(F.monotonically_increasing_id(), F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, _BLOCK_SCHEMA)


def piece_counts(words: DataFrame, name: str) -> DataFrame:
    """``(block, part, n)`` of ``(block, part, words)``: the piece counts of the words, in
    their order. Rows of a part are brought together, and the pieces of each pre-token
    are counted once (again only if ``REMEMBERED`` others of its part came between)."""
    def run(batches):
        c, known, of = counts(name), {}, None
        unpress = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for part, raw in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if part != of or len(known) > REMEMBERED:
                    known, of = {}, part
                units = [u or "\n" for u in unpress(raw).decode().split("\n")]
                new = [u for u in units if u not in known]
                known.update(zip(new, c.pieces(new), strict=True))
                out.append(_short(np.array([known[u] for u in units])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["block", "part", "n"])

    return words.repartition("part").sortWithinPartitions("part").mapInArrow(run, "block long, part int, n binary")


def _summed(batches):
    none = np.zeros(0, np.int64)
    for b in batches:
        for row, doc_id, n_bytes, size, code, freq, n in zip(*(b.column(i) for i in range(7)), strict=True):
            size = np.array(size.values, np.int64)
            ends = np.cumsum(size)
            upto = np.concatenate([[0], np.cumsum(_long(code.as_py()) + 1)])
            code = upto[1:] - np.repeat(upto[ends - size], size) - 1
            n = np.concatenate([none, *(_long(x) for x in n.as_py())])
            tokens = np.concatenate([[0], np.cumsum((_long(freq.as_py()) + 1) * n[code])])
            yield pa.RecordBatch.from_arrays(
                [row.values, doc_id.values, n_bytes.values, pa.array(tokens[ends] - tokens[ends - size])],
                ["row", "doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, name: str = "piece_bpe_32k.model", doc_id: str = "doc_id",
                 text: str = "text", limit: int = 4096, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    NULL and empty texts have no bytes and no tokens. Documents are told apart by row,
    so NULL and repeated ids are counted like others, and repeated rows give repeated
    results. A text of any length is counted whole, in parts. Other columns, whatever
    their names, are not looked at. No rows give no rows."""
    found = stored(blocks(docs, name, doc_id, text, block), "blocks")
    words = found.select("block", F.posexplode("words").alias("part", "words")).where("words IS NOT NULL")
    n = piece_counts(words, name).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("part", "n"))).alias("n"))  # MOST_PARTS at most
    # a block of empty texts has no words
    joined = found.join(n, "block", "left").select(
        "row", "doc_id", "n_bytes", "size", "code", "freq", F.coalesce(F.col("n.n"), F.array().cast("array<binary>")).alias("n"))
    summed = joined.mapInArrow(_summed, "row long, doc_id long, n_bytes long, n_tokens long")
    return summed.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"),
        F.sum("n_tokens").alias("n_tokens")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op12_tokencounts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op12_tokencounts": op12_tokencounts}
