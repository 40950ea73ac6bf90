"""Texts as slices of one array of bytes, so that each distinct slice is handled once.

A slice's result is looked up once for each distinct slice of many texts; Arrow finds
the distinct ones and puts the results together, without a Python object per slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts handled at a time, unless one text is longer.
GROUP = 1 << 23


def groups(batches, size: int = GROUP):
    """``(ids, texts)`` of two columns, several batches at a time or part of one. NULL
    texts are empty."""
    held, total, now = [], 0, 0

    def both():
        t = pa.Table.from_batches(held)
        texts = pc.fill_null(t.column(1).cast(pa.large_string()), "")
        return t.column(0).combine_chunks(), texts.combine_chunks()

    for b in batches:
        if not b.num_rows:
            continue
        ends = total + np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        number, first = ends // size, 0
        for stop in [*(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]:
            if held and number[first] != now:
                yield both()
                held = []
            now = number[first]
            held.append(b.slice(first, stop - first))
            first = stop
        total = int(ends[-1])
    if held:
        yield both()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (or other large binary values), and where each begins and
    the last ends."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]], at - at[0]


class Slices:
    """``cut`` tells before which byte of ``data`` a slice begins; texts, which begin and
    end at ``ends``, are cut apart in any case."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, cut: np.ndarray):
        cut[ends[:-1][ends[:-1] < ends[1:]]] = True
        starts = np.append(np.flatnonzero(cut), len(data))
        #: Number of the first slice of each text, and of all slices.
        self.first = np.searchsorted(starts, ends)
        found = pa.LargeStringArray.from_buffers(
            len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data)).dictionary_encode()
        #: The distinct slices, and which of them each slice is.
        self.each: list[str] = found.dictionary.to_pylist()
        self.which = found.indices.to_numpy()

    def together(self, values: list[bytes], end: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
        """What the slices of each text give, one after the other, and ``end`` behind
        each: bytes, and where each text begins and the last ends."""
        which, first = self.which, self.first
        if end is not None:
            which = np.insert(which, first[1:], len(values))
            first = first + np.arange(len(first))
            values = [*values, end]
        return _taken(pa.array(values, pa.large_binary()), which, first)


def _taken(values: pa.Array, which: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data, at = flat(values.take(pa.array(which)))
    return data, at[first]


class Memory:
    """Results by slice. The oldest go when there are ``size``, but what is in use stays."""

    def __init__(self, size: int, longest: int = 64):
        self.size, self.longest = size, longest
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def get(self, slices: list[str], learn) -> list[bytes]:
        """``learn`` gives the results of a list of slices, none of them known."""
        if len(self.now) > self.size // 2:
            self.before, self.now = self.now, {}
        now, before = self.now, self.before
        out = list(map(now.get, slices))
        gaps = [k for k, x in enumerate(out) if x is None]
        new = []
        for k in gaps:
            s = slices[k]
            x = before.get(s)
            if x is None:
                new.append(k)
            else:
                out[k] = now[s] = x
        if new:
            longest = self.longest
            texts = [slices[k] for k in new]
            for k, s, x in zip(new, texts, learn(texts), strict=True):
                out[k] = x
                if len(s) <= longest:
                    now[s] = x
        return out
