"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut where no piece of the vocabulary reaches across. The distinct units of many
texts are joined into one text and indexed by a suffix array, sorted as far as the longest piece reaches. Every
piece of the vocabulary is looked up in it by binary search; a range of the array is
all its occurrences. The occurrences are edges; they are sorted by position and
relaxed from left to right.

Relaxing gives the segmentation of the model's own merges: what a prefix ends with is
the one piece that may follow the last piece of what stands before it, and two pieces
may follow each other if merging their joined text gives just these two. Merging is
only ever done on such pairs, once per worker. Pieces of several blanks have equal
scores, so units with runs of blanks are merged as they are.
"""

from __future__ import annotations

import heapq
import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.slices import Memory, Slices, flat, groups
from filigree.llm.work import small_batches, table

BLANK = "▁"
#: Units, and pairs of pieces, that a Python worker remembers.
REMEMBERED = 400_000
#: Characters of new units that are indexed at a time, unless one unit is longer.
INDEXED = 1_000_000


class Model:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        self.size, self.unknown = len(every), sp.unk_id()
        self.bytes = {sp.id_to_piece(i): i for i in every if sp.is_byte(i)}
        self.byte = [self.bytes.get(f"<0x{b:02X}>") for b in range(256)]
        self.id = {sp.id_to_piece(i): i for i in every
                   if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.packed = {p: struct.pack("<i", i) for p, i in self.id.items()}
        self.longest = max(map(len, self.id))
        self.raw = [b""] * self.size
        for p, i in self.id.items():
            self.raw[i] = p.replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte):
            if i is not None:
                self.raw[i] = bytes([b])
        # no piece holds a line break, or a blank behind anything but blanks
        assert not any("\n" in p or BLANK in p.lstrip(BLANK) for p in self.id)
        names = sorted(self.id)
        self.names = np.array(names, object)
        self.low = self._keys(names, 0)
        self.high = self._keys(names, 255)
        # bytes that stand side by side in a piece, the latter beginning a character; no
        # character is cut
        self.border = np.ones((256, 256), bool)
        self.border[:, 0x80:0xC0] = False
        for p in self.id:
            raw = p.replace(BLANK, " ").encode()
            for a, b in itertools.pairwise(raw):
                self.border[a, b] = False
        self.memory = Memory(2 * REMEMBERED)
        self.bare = pa.array(self.raw, pa.large_binary())
        self.pairs: dict[tuple[str, str], bool] = {}
        #: What the last merge of a piece joins; empty for a character, None where unwinding does not hold.
        self.splits: dict[str, tuple | None] = {}
        counts: dict[float, int] = {}
        for s in self.score.values():
            counts[s] = counts.get(s, 0) + 1
        self.alike = {s for s, n in counts.items() if n > 1}

    def _keys(self, texts: list[str], fill: int) -> np.ndarray:
        out = np.full((len(texts), self.longest, 3), fill, np.uint8)
        for k, t in enumerate(texts):
            c = np.array([*map(ord, t)], ">u4") + np.uint32(1)
            out[k, :len(t)] = c.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]
        return out.reshape(len(texts), -1).view(f"S{3 * self.longest}")[:, 0]

    def merged(self, text: str, whole: bool = True) -> list[str]:
        """The pieces that merging leaves: always the pair whose joined text scores
        best, the leftmost of equals. Without ``whole``, no merge gives all of the text."""
        n = len(text)
        end, before, after = [i + 1 for i in range(n)], [i - 1 for i in range(n)], [i + 1 for i in range(n)]
        alive, heap = [True] * n, []

        def offer(i):
            j = after[i]
            if i >= 0 and j < n and (s := self.score.get(text[i:end[j]])) is not None:
                heapq.heappush(heap, (-s, i, end[i], end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[i] != middle or end[j] != stop or not whole and i == 0 and stop == n:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [text[i:end[i]] for i in range(n) if alive[i]]

    def _split(self, piece: str) -> tuple | None:
        """The two pieces that the last merge of ``piece`` joins, nothing if it is one
        character; None if merging does not give the piece, or not by merges that score
        better than it and unlike any other."""
        if piece not in self.splits:
            out = ()
            if len(piece) > 1:
                # all merges but the last one, which gives the whole
                out, s = None, self.score.get(piece)
                if s is not None and s not in self.alike and self.merged(piece) == [piece]:
                    halves = self.merged(piece, whole=False)
                    if len(halves) == 2 and all(len(x) == 1 or self._split(x) and self.score[x] > s for x in halves):
                        out = tuple(halves)
            self.splits[piece] = out
        return self.splits[piece]

    def _stand(self, left: str, right: str) -> bool:
        """Whether merging leaves two pieces, each with a split, as they are: their last
        merges are undone, the latest first, and at no time may the two pieces that meet
        join to one that would have been merged earlier."""
        score, splits, best = self.score, self._split, -np.inf
        tie = False  # whether an equal score, being further left, comes first as well
        while True:
            s = score.get(left + right)
            if s is not None and (s > best or tie and s == best):
                return False
            a, b = splits(left), splits(right)
            if a and (not b or score[left] < score[right]):
                best, tie, left = score[left], False, a[1]
            elif b:
                best, tie, right = score[right], True, b[0]
            else:
                return True

    def follows(self, left: str, right: str) -> bool:
        """``left`` is empty at the start of a unit."""
        if left and self._split(left) is not None and self._split(right) is not None:
            ok = self._stand(left, right)
        else:
            ok = self.merged(left + right) == ([left, right] if left else [right])
        self.pairs[left, right] = ok
        return ok

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End and piece (number in ``names``) of every occurrence in an array of code
        points (0 between units), sorted by end, the longest first."""
        code = np.append(np.where(text > 0, text + 1, 0), np.zeros(self.longest, np.uint32)).astype(">u4")
        three = np.ascontiguousarray(code.view(np.uint8).reshape(-1, 4)[:, 1:])
        rows = np.lib.stride_tricks.as_strided(three, (len(text), 3 * self.longest), (3, 1))
        keys = np.ascontiguousarray(rows).view(f"S{3 * self.longest}")[:, 0]
        suffixes = np.argsort(keys, kind="stable")
        keys = keys[suffixes]
        first = np.searchsorted(keys, self.low, "left")
        count = np.searchsorted(keys, self.high, "right") - first
        piece = np.repeat(np.arange(len(count)), count)
        place = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        size = self.sizes[piece]
        end = suffixes[place] + size
        order = np.lexsort((-size, end))
        return end[order], piece[order]

    @property
    def sizes(self) -> np.ndarray:
        if not hasattr(self, "_sizes"):
            self._sizes = np.array([len(x) for x in self.names])
        return self._sizes

    def _ids(self, parts: list[str]) -> bytes:
        try:
            return b"".join(map(self.packed.__getitem__, parts))
        except KeyError:
            out = []
        for p in parts:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            else:  # a character that the vocabulary lacks
                raw = [self.byte[b] for b in p.encode()]
                out.extend(raw if None not in raw else [self.unknown])
        return struct.pack(f"<{len(out)}i", *out)

    def _relax(self, unit: str, start: int, at: list[int], pieces: list[str]) -> list[str]:
        """``pieces[at[k]:at[k + 1]]`` end at place k of the joined text, in which the
        unit begins at ``start``. No piece reaches beyond a unit."""
        n, last, known, follows = len(unit), [""], self.pairs.get, self.follows
        i = at[start + 1]
        for k, j in enumerate(at[start + 2:start + n + 2], 1):
            for p in pieces[i:j]:
                before = last[k - len(p)]
                ok = known((before, p))
                if ok is None:
                    ok = follows(before, p)
                if ok:
                    last.append(p)
                    break
            else:
                last.append(unit[k - 1])  # a character that is no piece may always stand
            i = j
        out, k = [], n
        while k > 0:
            out.append(last[k])
            k -= len(last[k])
        return out[::-1]

    def _learn(self, units: list[str]) -> list[bytes]:
        """The ids of each unit."""
        out, plain = [b""] * len(units), []
        for k, u in enumerate(units):
            t = u.replace(" ", BLANK)
            if BLANK * 2 in t:
                out[k] = self._ids(self.merged(t))
            else:
                plain.append((k, t))
        i = 0
        while i < len(plain):
            j, size = i, 0
            while j < len(plain) and (j == i or size + len(plain[j][1]) < INDEXED):
                size += len(plain[j][1]) + 1
                j += 1
            for (k, _), ids in zip(plain[i:j], self._index([t for _, t in plain[i:j]]), strict=True):
                out[k] = ids
            i = j
        return out

    def _index(self, plain: list[str]) -> list[bytes]:
        joined = "\0".join(plain)
        text = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        # code 0 parts the units; one that a unit holds is in no piece either
        ends, pieces = self.edges(text)
        names = self.names[pieces].tolist()
        at = np.searchsorted(ends, np.arange(len(text) + 2)).tolist()
        start, out = 0, []
        for t in plain:
            out.append(self._ids(self._relax(t, start, at, names)))
            start += len(t) + 1
        return out

    def _spaced(self, texts: pa.Array) -> pa.Array:
        """Texts as the model takes them: a blank in front, but for empty ones."""
        if pc.any(pc.match_substring(texts, BLANK)).as_py():
            texts = pc.replace_substring(texts, BLANK, " ")
        blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(blank, texts, none))

    def joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and at which of them each text begins and the last ends."""
        if len(self.pairs) > 2 * REMEMBERED:
            self.pairs.clear()
        data, ends = flat(self._spaced(texts))
        cut = np.ones(len(data), bool)
        cut[1:] = self.border[data[:-1], data[1:]]
        s = Slices(data, ends, cut)
        ids, at = s.together(self.memory.get(s.each, self._learn))
        return ids.view("<i4"), at // 4

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, at = self.joined(pa.array(texts, pa.large_string()))
        return [ids[a:b] for a, b in itertools.pairwise(at.tolist())]

    def exact(self, texts: pa.Array, ids: np.ndarray, at: np.ndarray) -> list[bool]:
        """Whether decoding the ids of each text, as ``joined`` gives them, gives it back."""
        raw, ends = flat(self.bare.take(pa.array(ids)))
        ends = ends[at].tolist()
        blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        want, to = flat(pc.binary_join_element_wise(blank, texts, none))
        raw, want, to, at, out = memoryview(raw), memoryview(want), to.tolist(), at.tolist(), []
        for k in range(len(texts)):
            a, b = ends[k:k + 2]
            # equal bytes decode to equal texts; what else does is seen by decoding
            out.append(raw[a:b] == want[to[k]:to[k + 1]] or self.decode(ids[at[k]:at[k + 1]]) == texts[k].as_py())
        return out

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return raw[1:] if raw[:1] == " " else raw


_MODELS: dict[str, Model] = {}


def model(name: str) -> Model:
    """One per Python worker. The file is found on the machine the worker runs on."""
    if name not in _MODELS:
        import public_tokenizers

        _MODELS[name] = Model(public_tokenizers.path(name))
    return _MODELS[name]


def encoded(docs: DataFrame, name: str = "piece_bpe_32k.model", doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, exact, ids)``, one row per row of ``docs``.

    ``ids_crc32`` is of the ids as little-endian 32-bit numbers; ``exact`` tells whether
    decoding the ids gives the text back (a text with a literal U+2581 decodes to
    blanks there). NULL and empty texts have no ids. Ids of documents are not looked at,
    so NULL and repeated ones are encoded like others; no rows give no rows."""
    small_batches(docs.sparkSession)

    def run(batches):
        m = model(name)
        for doc, texts in groups(batches):
            ids, at = m.joined(texts)
            yield pa.RecordBatch.from_arrays([
                doc, pa.array(np.diff(at), pa.int64()),
                pa.array([zlib.crc32(ids[a:b]) for a, b in itertools.pairwise(at.tolist())], pa.int64()),
                pa.array(m.exact(texts, ids, at), pa.bool_()),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))],
                ["doc_id", "n_tokens", "ids_crc32", "exact", "ids"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, exact boolean, ids array<int>")


def decoded(rows: DataFrame, name: str = "piece_bpe_32k.model", doc_id: str = "doc_id",
            ids: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of rows with an array of ids; NULL gives an empty text."""
    small_batches(rows.sparkSession)

    def run(batches):
        m = model(name)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [m.decode(np.array(x or [], np.int32)) for x in b.column(1).to_pylist()], pa.string())],
                ["doc_id", "text"])

    return rows.select(F.col(doc_id).cast("long"), F.col(ids).cast("array<int>")).mapInArrow(
        run, "doc_id long, text string")


def op2_sentencepiece(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents")).drop("ids")


QUERIES = {"op2_sentencepiece": op2_sentencepiece}
