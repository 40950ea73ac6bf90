"""Token ids as files of frequency-ranked, byte-aligned variable-length numbers.

Ids are replaced by their rank in the corpus, so that frequent ids are small. A number
takes 1 to 4 bytes, its length less one goes as 2 bits into a separate stream of
control bytes, four numbers to a byte. Decoding looks the control bytes up in a table
of 256 x 4 lengths and gathers the data bytes with numpy; there is no loop over
numbers.

Format: a folder with ``blocks/`` and ``ranks/``, both Parquet. A row of ``blocks`` is
a run of documents in ascending id order (``part``, ``block``, ``doc_ids``,
``lengths``, ``control``, ``data``); ``ranks`` has one row per id (``id``, ``rank``).
Parts ascend, and blocks within a part. Spark's writers commit the files, so a lost
executor leaves no half-written part.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filigree.llm.slices import Memory, Slices, flat, groups
from filigree.llm.work import folder, small_batches, stored, table

END = 0
#: Numbers in a block, but a document is never cut.
BLOCK = 1 << 18
#: Slices whose ids a Python worker remembers (about 200 bytes each).
REMEMBERED = 1_000_000

#: Lengths of the four numbers of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3) + 1


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    x = np.ascontiguousarray(numbers, dtype="<u4")
    more = (x > 0xFF).astype(np.uint8) + (x > 0xFFFF) + (x > 0xFFFFFF)
    data = x.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    four = np.zeros(-(-len(x) // 4) * 4, np.uint8)
    four[:len(x)] = more
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``pack`` packed."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


#: Kinds of bytes: unclear, letter, digit, mark, apostrophe, white space, blank, and other
#: characters that are no white space.
UNCLEAR, LETTER, DIGIT, MARK, APOSTROPHE, WHITE, SPACE, OTHER = range(8)


def _kinds() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for kind, some in (
            (LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), (DIGIT, b"0123456789"),
            (MARK, b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"), (APOSTROPHE, b"'"), (WHITE, b"\t\n\r"), (SPACE, b" ")):
        out[np.frombuffer(some, np.uint8)] = kind
    # first bytes of longer characters; U+00C0 to U+023F and U+0400 to U+047F are letters
    out[0xC2:0xF5] = OTHER
    out[[0xC3, 0xC4, 0xC5, 0xC6, 0xC7, 0xC8, 0xD0, 0xD1]] = LETTER
    return out


def _borders() -> np.ndarray:
    """By the kinds of three characters in a row: whether the first two can be encoded apart."""
    a, b, c = np.ogrid[:8, :8, :8]
    clear = [LETTER, DIGIT, MARK, APOSTROPHE, OTHER]
    white = np.isin(b, [WHITE, SPACE])
    out = np.isin(a, clear) & white  # white space begins
    out = out | white & np.isin(c, clear)  # its last character never belongs to those before
    out = out | (a == WHITE) & np.isin(b, clear)
    # letters, digits and marks are parted, but an apostrophe may take letters
    out = out | (a == LETTER) & np.isin(b, [DIGIT, MARK, APOSTROPHE])
    out = out | (a == DIGIT) & np.isin(b, [LETTER, MARK, APOSTROPHE])
    out = out | (a == MARK) & np.isin(b, [LETTER, DIGIT])
    return out.ravel()


KINDS, BORDERS = _kinds(), _borders()


def borders(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Before which bytes of texts, one after the other, byte-level splitting begins a
    token whatever stands on the other side. Not all such places are found."""
    kind = KINDS[data]
    first = np.flatnonzero(data >= 0xC2)
    if len(first):
        x, y, k = data[first], data[first + 1], kind[first]
        k[(x == 0xC3) & ((y == 0x97) | (y == 0xB7))] = OTHER
        k[(x == 0xC2) & ((y == 0x85) | (y == 0xA0))] = UNCLEAR
        k[(x == 0xE1) & ((y == 0x9A) | (y == 0xA0))] = UNCLEAR
        k[(x == 0xE2) & (y == 0x81)] = UNCLEAR
        at = np.flatnonzero((x == 0xE2) & (y == 0x80) | (x == 0xE3) & (y == 0x80))
        z = data[first[at] + 2]
        k[at[(z < 0x90) | np.isin(z, [0xA8, 0xA9, 0xAF])]] = UNCLEAR
        kind[first] = kind[first + 1] = k
        for longer, by in ((0xE0, 2), (0xF0, 3)):
            m = x >= longer
            kind[first[m] + by] = k[m]
    three = kind.astype(np.uint16)
    three <<= 3
    three[1:] |= kind[:-1].astype(np.uint16) << 6
    three[:-1] |= kind[1:]
    last = ends[1:][ends[1:] > ends[:-1]] - 1
    three[last] &= ~np.uint16(7)  # nothing follows in the same text
    return BORDERS[three]


class Encoder:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    Texts are cut where its splitting always begins a token (``borders``), and each
    distinct slice is encoded once per worker, many in one string where the ids tell
    them apart. Added tokens are slices of their own, and what is between them is split
    as texts of their own are; texts that hold one with a rule for what is beside it are
    encoded whole.
    """

    #: Slices that can be encoded many in one string.
    PLAIN = re.compile(r" ?\S{1,64}").fullmatch

    def __init__(self, path: str):
        # tasks run side by side; threads of their own would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.starts = np.zeros(self.size, bool)
        self.starts[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.breaks = np.zeros(self.size, bool)
        self.breaks[[i for t, i in vocabulary.items() if t == "Ċ"]] = True
        self.added, self.ruled = [], []
        for t in self.tokenizer.get_added_tokens_decoder().values():
            ruled = t.lstrip or t.rstrip or t.single_word or t.normalized
            (self.ruled if ruled else self.added).append(t.content)
        longest = sorted(self.added, key=len, reverse=True)
        self.places = re.compile(b"|".join(re.escape(t.encode()) for t in longest)).finditer
        self.memory = Memory(REMEMBERED)

    def _encoded(self, texts: list[str]):
        # one at a time: what the library returns is many times as large as the ids
        for t in texts:
            e, = self.tokenizer.encode_batch_fast([t], add_special_tokens=False)
            yield np.array(e.ids, self.kind)

    def _learn(self, slices: list[str]) -> list[bytes]:
        """The ids of each slice."""
        out: list[bytes] = [b""] * len(slices)
        plain, alone, step = ([], []), [], self.kind.itemsize
        for k, s in enumerate(slices):
            (plain[s[0] != " "] if self.PLAIN(s) else alone).append(k)
        for bare, some in enumerate(plain):
            # the blanks that slices begin with tell them apart, or line breaks between them
            mark, after = ((self.starts, 0), (self.breaks, 1))[bare]
            runs = [some[i:i + 200] for i in range(0, len(some), 200)]
            for run, ids in zip(runs, self._encoded([("\n" * bare).join([slices[k] for k in run]) for run in runs]), strict=True):
                at = np.flatnonzero(mark[ids])
                if bare:
                    at = np.append(-1, at)
                if len(at) != len(run) or at[0] + after:
                    alone += run
                    continue
                raw, first = ids.tobytes(), ((at + after) * step).tolist()
                last = [*(at[1:] * step).tolist(), len(raw)]
                for k, a, b in zip(run, first, last, strict=True):
                    out[k] = raw[a:b]
        for k, ids in zip(alone, self._encoded([slices[k] for k in alone]), strict=True):
            out[k] = ids.tobytes()
        return out

    @staticmethod
    def _holding(texts: pa.Array, some: list[str]) -> set[int]:
        return {k for t in some for k in np.flatnonzero(pc.match_substring(texts, t).to_numpy(zero_copy_only=False)).tolist()}

    def joined(self, texts: pa.Array, end: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, as bytes of little-endian numbers of ``self.kind``,
        ``end`` behind each, and at which byte each text begins and the last ends."""
        data, ends = flat(texts)
        added = [(ends[k] + m.start(), ends[k] + m.end()) for k in self._holding(texts, self.added)
                 for m in self.places(data[ends[k]:ends[k + 1]])]
        added = np.array(added, np.int64).reshape(-1, 2)
        cut = borders(data, np.union1d(ends, added))
        for a, b in added.tolist():
            cut[a:b] = False
        cut[added[added < len(data)]] = True
        for k in self._holding(texts, self.ruled):
            cut[ends[k]:ends[k + 1]] = False
        s = Slices(data, ends, cut)
        return s.together(self.memory.get(s.each, self._learn), end)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian numbers of ``self.kind``."""
        data, ends = self.joined(pa.array(texts, pa.large_string()))
        return [data[a:b].tobytes() for a, b in itertools.pairwise(ends.tolist())]


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One per Python worker. The file is found on the machine the worker runs on."""
    if name not in _ENCODERS:
        import public_tokenizers

        _ENCODERS[name] = Encoder(public_tokenizers.path(name))
    return _ENCODERS[name]


def encoded(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the ids of each whole text and the end id, as bytes."""
    small_batches(docs.sparkSession)

    def run(batches):
        e = encoder(name)
        end = np.array([END], e.kind).tobytes()
        for ids, texts in groups(batches):
            data, ends = e.joined(texts, end)
            yield pa.RecordBatch.from_arrays([
                ids.cast(pa.int64()), pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())],
                ["doc_id", "ids"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, ids binary")


def ranked(ids: DataFrame, kind: np.dtype, size: int) -> DataFrame:
    """``(id, rank)`` of every id of the vocabulary, the most frequent first."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    counts = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    every = ids.sparkSession.range(size).join(counts, "id", "left").fillna(0, ["n"])
    # as many rows as the vocabulary has ids, whatever the corpus
    return every.select("id", (F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).alias("rank"))


def _blocks(kind: np.dtype, ranks: np.ndarray, block: int):
    names = ["part", "block", "doc_ids", "lengths", "control", "data"]

    def run(batches):
        part, number, ids, docs, held = TaskContext.get().partitionId(), 0, [], [], 0
        for b in batches:
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(np.frombuffer(raw, kind))
                docs.append(doc)
                held += len(ids[-1])
                if held >= block:
                    yield emit(part, number, docs, ids)
                    number, ids, docs, held = number + 1, [], [], 0
        if docs:
            yield emit(part, number, docs, ids)

    def emit(part, number, docs, ids):
        control, data = pack(ranks[np.concatenate(ids)])
        return pa.RecordBatch.from_arrays([
            pa.array([part]), pa.array([number]), pa.array([docs], pa.list_(pa.int64())),
            pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
            pa.array([control], pa.binary()), pa.array([data], pa.binary())], names)

    return run


def write_ids(docs: DataFrame, path: str, name: str = "byte_bpe_50k.json", doc_id: str = "doc_id",
              text: str = "text", block: int = BLOCK) -> None:
    """Encode ``docs`` and write them below ``path`` in ascending id order.

    A NULL or empty text is the end id alone. NULL ids come first; rows that share an id
    are all written, in the order of a hash of their ids. An empty table gives a folder
    without blocks. Other columns are not looked at."""
    e = encoder(name)
    ids = stored(encoded(docs, name, doc_id, text), "ids")
    ranked(ids, e.kind, e.size).coalesce(1).write.parquet(f"{path}/ranks")
    order = docs.sparkSession.read.parquet(f"{path}/ranks").orderBy("id").select("rank").toPandas()
    ranks = order["rank"].to_numpy().astype(np.uint32)  # bounded by the vocabulary
    # rows that share an id, or lack one, are dealt out as well
    spread = ids.withColumn("by", F.xxhash64("ids"))
    spread.repartitionByRange("doc_id", "by").sortWithinPartitions("doc_id", "by", "ids").drop("by").mapInArrow(
        _blocks(e.kind, ranks, block),
        "part long, block long, doc_ids array<long>, lengths array<long>, control binary, data binary"
    ).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of each document in the files of ``path``, the
    end id included; ``start`` counts the ids of all documents before it. With
    ``digest``, ``ids_crc32`` (of the ids as little-endian 32-bit numbers) instead of
    ``ids``."""
    small_batches(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    order = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").toPandas()
    by_rank = order["id"].to_numpy().astype("<u4")

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                n = np.array(row["lengths"])
                ids = by_rank[unpack(row["control"], row["data"], int(n.sum()))]
                ends = np.cumsum(n)
                each = np.split(ids, ends[:-1])
                last = pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()) if digest \
                    else pa.array(each, pa.list_(pa.uint32())).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * len(n)),
                    pa.array([row["block"]] * len(n)), pa.array(ends - n), pa.array(n), last],
                    ["doc_id", "part", "block", "inside", "n_tokens", "last"])

    # one narrow row per block and part: where each begins
    size = blocks.select("part", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = size.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("p"))
    starts = size.withColumn("b", F.coalesce(F.sum("n").over(before), F.lit(0))).join(parts, "part").select(
        "part", "block", (F.col("p") + F.col("b")).alias("base"))
    kind, last = ("long", "ids_crc32") if digest else ("array<int>", "ids")
    docs = blocks.mapInArrow(
        run, f"doc_id long, part long, block long, inside long, n_tokens long, last {kind}")
    return docs.join(stored(starts.coalesce(1), "starts"), ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", F.col("last").alias(last))


def op1_token_ids(spark, sf_dir):
    path = folder(spark)
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path, digest=True)


QUERIES = {"op1_token_ids": op1_token_ids}
