"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors are one node with a count. Cells are the Voronoi cells of centres fitted
on a bounded sample; cells that are still large are divided, by centres of their own,
rows of that sample. Every vector has one home cell and also visits each cell whose border
is near. Of two vectors with a border between their homes one is no further from it than
half their distance, so margins are halved: links that only one end meets are counted for
both. Two vectors at distance d differ by about d / sqrt(dim) across a border, so a margin of
2.5 such deviations of the longest linked distance loses few links.

A shard is a block of at most about ``BLOCK`` vectors that are at home in a cell, where a
cell has several the next block as well, and about as many from beyond the border, so
shards overlap and none holds much more than three blocks. On each shard a graph is built: nearest neighbours and a few far ones, pruned
robustly (a neighbour goes if one that is kept is closer to it by the factor ``ALPHA``),
with the way back. The adjacency lists of a vector in the shards of a cell are united. All
members of a cell search each of its shards, streamed past it: greedily from the medoid,
then on through all neighbours of what is near enough. A hit counts where it is at home
and in its own block, so it counts once, and only with a cosine, in double precision, of
at least the bound. Counts and a spanning forest leave a shard, never all pairs.

On disk there is one copy of the nodes, with the cells that they visit. Vectors go to their
cells in rounds of some of the cells, about as many vectors a round as there are nodes, and
up to ``LARGE`` shards of a cell get them as one row.

The links of some vectors are then counted by comparing them with all others. If too few
were found, all is done again with a wider margin, up to the distance that loses none.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.components import components
from filigree.llm.work import freed, let_go, stored, table

COSINE, SAMPLE, CELL, CELLS, BLOCK = 0.95, 20_000, 1000, 1024, 1000
#: Deviations of a linked difference that the margin covers, at first and if recall is
#: below ``RECALL`` of the links of ``AUDITED`` vectors; infinity is the whole distance.
MARGINS, RECALL, AUDITED = (2.5, 5.0, float("inf")), 0.95, 256
#: So many blocks of a cell are searched by one task; a cell of more than half as many is
#: divided by up to ``PARTS`` centres of its own.
LARGE, PARTS = 8, 64
NEAR, FAR, DEGREE, ALPHA, BEAM = 32, 4, 12, 1.2, 12
#: Visitors that search at a time; vectors that are sent in one round however few nodes there are.
VISITORS, ROUND = 1024, 500_000
#: Beyond what single precision may be wrong by.
SINGLE = 1e-5


def component_kind(rows: DataFrame, vector: str) -> str:
    """What ``unit_vectors`` keeps the components of a vector in: as given if that is single."""
    return "f4" if dict(rows.select(F.col(vector).alias("v")).dtypes)["v"] == "array<float>" else "f8"


def unit_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, key, v)``: ``v`` are a vector's components as bytes (of the vector of
    length one if they are doubles), ``key`` tells vectors that are equal at length one. Both are NULL if the
    vector is NULL or zero or has a NULL or non-finite component."""
    kind = component_kind(rows, vector)

    def run(batches):
        for b in batches:
            col = b.column(1)
            first = np.asarray(col.offsets, np.int64)
            size = np.where(np.asarray(col.is_null()), 0, np.diff(first))
            flat = col.values.to_numpy(zero_copy_only=False)  # None becomes nan
            keys, out = [None] * len(size), [None] * len(size)
            for k in np.unique(size[size > 0]).tolist():
                who = np.nonzero(size == k)[0]
                given = flat[first[who][:, None] + np.arange(k)]
                v = given.astype(np.float64)
                with np.errstate(all="ignore"):
                    n = np.sqrt(np.einsum("ij,ij->i", v, v))
                    huge = ~np.isfinite(n) & np.isfinite(v).all(1)
                    v[huge] /= np.abs(v[huge]).max(1, keepdims=True)
                    n[huge] = np.linalg.norm(v[huge], axis=1)
                    v /= n[:, None]
                fine = np.nonzero((n > 0) & np.isfinite(n))[0]
                kept = given if kind == "f4" else v
                for j, i in zip(fine.tolist(), who[fine].tolist(), strict=True):
                    keys[i] = hashlib.md5(v[j].tobytes(), usedforsecurity=False).digest()
                    out[i] = kept[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array(out, pa.binary())], ["vec_id", "key", "v"])

    return rows.select(F.col(vec_id).cast("long"), F.col(vector).cast(
        "array<float>" if kind == "f4" else "array<double>")).mapInArrow(run, "vec_id long, key binary, v binary")


def _unit(raw, n: int, kind: str) -> np.ndarray:
    """Vectors of length one, of the bytes of ``n`` vectors of one size."""
    v = np.frombuffer(raw, kind).reshape(n, -1).astype(np.float64)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _bytes_of(col: pa.Array) -> np.ndarray:
    """The bytes of a column of binary values, one after the other."""
    first = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[first[0]:first[-1]]


def _by_size(col: pa.Array, kind: str):
    """``(size, rows, vectors)`` for each size of the values of ``col``, in bytes."""
    size = np.diff(np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1])
    for k in np.unique(size).tolist():
        who = np.nonzero(size == k)[0]
        part = col if len(who) == len(col) else col.take(pa.array(who))
        yield k, who, _unit(_bytes_of(part), len(who), kind)


def centres(sample: list[bytes], n: int, cell: int, seed: int = 3) -> dict[int, np.ndarray]:
    """Per length of vector, centres by a few rounds of spherical k-means; ``n`` vectors
    are expected in all."""
    found, rng = {}, np.random.default_rng(seed)
    for size in {len(x) for x in sample}:
        x = np.frombuffer(b"".join(s for s in sample if len(s) == size)).reshape(-1, size // 8)
        k = max(1, min(CELLS, len(x) // 8, round(n * len(x) / len(sample) / cell)))
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(6):
            home = (x @ c.T).argmax(1)
            total = np.zeros_like(c)
            np.add.at(total, home, x)
            norm = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(norm > 0, total / np.maximum(norm, 1e-12), c)
        found[size] = c
    return found


def divided(found: dict[int, np.ndarray], sample: list[bytes], n: int, block: int) -> dict[int, np.ndarray]:
    """Centres with those of large cells replaced by up to ``PARTS`` of the sampled vectors
    at home there, one for every ``LARGE / 2`` blocks that ``n`` vectors are expected to give it."""
    out = {}
    for size, c in found.items():
        x = np.frombuffer(b"".join(s for s in sample if len(s) == size)).reshape(-1, size // 8)
        home = (x @ c.T).argmax(1)
        parts = np.ceil(np.bincount(home, minlength=len(c)) * n / len(sample) / (LARGE / 2 * block))
        own = [x[home == k][:int(min(parts[k], PARTS))] if parts[k] > 1 else c[k:k + 1] for k in range(len(c))]
        out[size] = np.concatenate(own)
    return out


def margin_of(size: int, cosine: float, deviations: float) -> float:
    """How near a border may be, for vectors of ``size`` components: half of what both
    sides of it have to cover."""
    longest = float(np.sqrt(max(0.0, 2 - 2 * cosine))) * (1 + 1e-9)
    return min(longest, deviations * longest / max(size, 1) ** 0.5) / 2


def _visited(x: np.ndarray, c: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and cells they go to, in order, and which cell is each row's home. In single
    precision, with as much more margin."""
    x, c = x.astype(np.float32), c.astype(np.float32)
    whos, cells, homes = [], [], []
    length = np.einsum("ij,ij->i", c, c)
    for a in range(0, len(x), step := max(16, (1 << 22) // len(c))):
        part = x[a:a + step]
        dot = part @ c.T
        home = dot.argmax(1)
        best = dot[np.arange(len(part)), home]
        who, cell = np.nonzero(dot >= (best - 2 * margin - SINGLE)[:, None])  # no two centres are further apart than 2
        at = home[who]
        apart = np.sqrt(np.maximum(length[at] + length[cell] - 2 * np.einsum("ij,ij->i", c[at], c[cell]), 0))
        near = (best[who] - dot[who, cell] <= margin * apart + SINGLE) | (cell == at)
        whos.append(who[near] + a)
        cells.append(cell[near])
        homes.append(home)
    return tuple(np.concatenate([np.zeros(0, int), *r]) for r in (whos, cells, homes))


def assigned(nodes: DataFrame, found: dict[int, np.ndarray], cosine: float, deviations: float, kind: str) -> DataFrame:
    """``nodes`` with the ``size`` of ``v``, ``at``, the home cell of each, and ``visits``, all cells that it goes
    to, its home among them; numbers of cells are per size. ``found`` is by size in doubles."""
    shared = nodes.sparkSession.sparkContext.broadcast(found)
    scale, columns = 8 // np.dtype(kind).itemsize, nodes.columns

    def run(batches):
        for b in batches:
            b = pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns)], columns)
            for size, rows, x in _by_size(b.column("v"), kind):
                part = b if len(rows) == b.num_rows else b.take(pa.array(rows))
                c = shared.value.get(size * scale, np.zeros((1, x.shape[1])))
                who, cell, home = _visited(x, c, margin_of(x.shape[1], cosine, deviations))
                first = np.searchsorted(who, np.arange(len(rows) + 1))
                visits = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(cell, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.full(len(rows), size, np.int32)), pa.array(home, pa.int32()), visits],
                    [*columns, "size", "at", "visits"])

    schema = ", ".join(f"{c} {t}" for c, t in nodes.dtypes)
    return nodes.mapInArrow(run, f"{schema}, size int, at int, visits array<int>")


def sizes(members: DataFrame, block: int) -> DataFrame:
    """``(cell, h, g, n, w)``: vectors at home and others, blocks of these; a cell without
    any at home is none."""
    return members.groupBy("cell").agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("g")).where("h > 0").select(
        "cell", "h", "g", F.ceil(F.col("h") / block).cast("int").alias("n"),
        F.greatest(F.ceil(F.col("g") / block), F.lit(1)).cast("int").alias("w"))


def dealt(members: DataFrame, block: int, together: int = 1, size: DataFrame | None = None) -> DataFrame:
    """``(shard, side, cid, m, v, target)``: nodes of a shard (``side`` 0), and all members
    of its cell as visitors (``side`` 1). Nodes are a block of those at home, where there
    are several blocks the next one too, and about a block of those from beyond the
    border; a cell without any at home has no shard. With ``together`` this many shards side by
    side get their rows as one. Further columns of ``members`` stay, behind them come
    ``own``, the block of a row, and ``n``, the blocks of its cell."""
    size = sizes(members, block) if size is None else size
    more = [c for c in members.columns if c not in ("cell", "cid", "m", "v", "home")]
    rows = members.join(F.broadcast(size.select("cell", "n", "w")), "cell").withColumn(  # as many rows as cells
        "own", F.pmod(F.xxhash64("cid"), F.col("n")).cast("int"))
    group = lambda c: F.floor(c / together).cast("int")
    beyond = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("w")) == 0
    both = F.array_distinct(F.array(group(F.col("own")), group(F.pmod(F.col("own") + 1, F.col("n")))))
    groups = F.when(F.col("home"), both).when(beyond, F.array(group(F.col("own")))).otherwise(F.array().cast("array<int>"))
    asked = F.sequence(F.lit(0), group(F.col("n") - 1))
    to = F.concat(F.transform(groups, lambda g: F.struct(g.alias("group"), F.lit(0).alias("side"))),
                  F.transform(asked, lambda g: F.struct(g.alias("group"), F.lit(1).alias("side"))))
    return rows.withColumn("to", F.explode(to)).select(
        F.concat_ws("/", "cell", "to.group").alias("shard"), "to.side", "cid", "m", "v",
        (F.col("home") & (group(F.col("own")) == F.col("to.group"))).alias("target"), *more, "own", "n")


def pruned(x: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Edges (both ways) of a graph over the rows of ``x``."""
    n, rng = len(x), np.random.default_rng(seed)
    if n < 2:
        return np.zeros(0, int), np.zeros(0, int)
    near, starts, ends = min(NEAR, n - 1), [], []
    for a in range(0, n, 256):
        part = x[a:a + 256]
        rows = np.arange(len(part))
        sim = part @ x.T
        sim[rows, rows + a] = -2
        pool = np.argpartition(sim, n - near, axis=1)[:, n - near:]
        pool = np.concatenate([pool, rng.integers(0, n, (len(part), FAR))], axis=1)
        s = np.take_along_axis(sim, pool, 1)
        order = np.argsort(-s, axis=1, kind="stable")
        pool, s = np.take_along_axis(pool, order, 1), np.take_along_axis(s, order, 1)
        v = x[pool]
        # by candidate first: what is compared in turn lies together
        between = np.ascontiguousarray((ALPHA - ALPHA * np.matmul(v, v.transpose(0, 2, 1))).transpose(1, 2, 0))
        far = np.ascontiguousarray((1 - s).T)
        alive, kept = np.ascontiguousarray((s > -2).T), np.zeros(len(part), int)
        for k in range(pool.shape[1]):
            keep = alive[k] & (kept < DEGREE)
            kept += keep
            alive[k] = keep
            alive[k + 1:] &= ~(keep & (between[k, k + 1:] <= far[k + 1:]))
        who, at = np.nonzero(alive.T)
        starts.append(who + a)
        ends.append(pool[who, at])
    a, b = np.concatenate(starts), np.concatenate(ends)
    both = np.unique(np.concatenate([a * n + b, b * n + a]))
    return both // n, both % n


def united(x: np.ndarray, shards: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per shard (rows of ``x``) the lists of neighbours, as places in the shard: those
    that any shard's graph gives and that are in this one, and where each list begins."""
    n, edges = len(x), [np.zeros(0, int)]
    for rows in shards:
        a, b = pruned(x[rows])
        edges.append(rows[a] * n + rows[b])
    edges = edges[1] if len(edges) == 2 else np.unique(np.concatenate(edges))
    out = []
    for rows in shards:
        place = np.full(n, -1)
        place[rows] = np.arange(len(rows))
        a, b = place[edges // n], place[edges % n]
        inside = np.nonzero((a >= 0) & (b >= 0))[0]
        inside = inside[np.argsort(a[inside], kind="stable")]
        out.append((np.searchsorted(a[inside], np.arange(len(rows) + 1)).astype(np.int32), b[inside].astype(np.int32)))
    return out


def _step(flat, mark, front, row, least, first, nbrs, n):
    """Neighbours of ``front`` that are more similar than ``least`` of their ``row`` and were not
    given before, with their similarities and rows. ``front`` is in order of ``row``, the queries."""
    node = front - row * np.int32(n)
    begin = first[node]
    count = first[node + 1] - begin
    ends = np.cumsum(count, dtype=np.int32)
    of = np.repeat(np.arange(len(front), dtype=np.int32), count)
    key = nbrs[np.arange(len(of), dtype=np.int32) + (begin - ends + count)[of]] + (front - node)[of]
    s = flat[key]
    more = np.nonzero(s > least[row][of])[0]
    key, s = key[more], s[more]
    flat[key] = -9
    turn = np.arange(len(key), dtype=np.int32)
    mark[key] = turn
    once = mark[key] == turn
    return key[once], s[once], row[of[more[once]]]


def _search(sim, mark, first, nbrs, medoid, bound):
    """``(query, row, similarity)`` of the rows that are as similar as ``bound`` or more, as far as
    the graph leads there: from the medoid on through the ``BEAM`` best, then through
    whatever is near enough. ``sim`` (queries x rows) is used up, ``mark`` is room as large."""
    q, n = sim.shape
    flat, row = sim.reshape(-1), np.arange(q, dtype=np.int32)
    under = np.full(q, np.nextafter(np.float32(bound), np.float32(-9)))
    best, beam, fresh = np.full((q, BEAM), -4, np.float32), np.zeros((q, BEAM), np.int32), np.zeros((q, BEAM), bool)
    beam[:, 0] = row * np.int32(n) + np.int32(medoid)
    best[:, 0], fresh[:, 0] = flat[beam[:, 0]], True
    flat[beam[:, 0]] = -9
    hit = best[:, 0] > under
    found, values, rows = [beam[hit, 0]], [best[hit, 0]], [row[hit]]
    worst = best.min(1)
    while fresh.any():
        front, row = beam[fresh], np.nonzero(fresh)[0].astype(np.int32)
        fresh[:] = False
        new, s, row = _step(flat, mark, front, row, np.minimum(worst, under), first, nbrs, n)
        hit = s > under[0]
        if hit.any():
            found.append(new[hit])
            values.append(s[hit])
            rows.append(row[hit])
            better = s > worst[row]
            new, s, row = new[better], s[better], row[better]
        if not len(row):
            break
        count = np.bincount(row, minlength=q)
        some = np.nonzero(count)[0]
        wide = BEAM + int(count.max())
        place = np.arange(BEAM, BEAM + len(row)) - (np.cumsum(count) - count)[row]  # rows come in order
        place += (np.cumsum(count > 0) - 1)[row] * wide
        all_s, all_k = np.full((len(some), wide), -4, np.float32), np.zeros((len(some), wide), np.int32)
        all_s[:, :BEAM], all_k[:, :BEAM] = best[some], beam[some]
        all_s.reshape(-1)[place], all_k.reshape(-1)[place] = s, new
        top = np.argpartition(all_s, wide - BEAM, axis=1)[:, wide - BEAM:]
        at = top + np.arange(0, all_s.size, wide)[:, None]
        top_s = all_s.reshape(-1)[at]
        best[some], beam[some], fresh[some], worst[some] = top_s, all_k.reshape(-1)[at], (top >= BEAM) & (top_s > -4), top_s.min(1)
    front, row = np.concatenate(found), np.concatenate(rows)
    while len(front):  # the range goes on through whatever is near enough
        order = np.argsort(row, kind="stable")
        front, s, row = _step(flat, mark, front[order], row[order], under, first, nbrs, n)
        found.append(front)
        values.append(s)
        rows.append(row)
    row = np.concatenate(rows)
    return row, np.concatenate(found) - row * np.int32(n), np.concatenate(values)


def _pieces(batches):
    """``(shard, side, rows)``: runs of rows of one shard and side, ``VISITORS`` at most."""
    for b in batches:
        if not b.num_rows:
            continue
        shard = np.asarray(b.column(0).dictionary_encode().indices)
        side = np.asarray(b.column(1))
        ends = np.nonzero((shard[1:] != shard[:-1]) | (side[1:] != side[:-1]))[0] + 1
        for a, z in zip([0, *ends.tolist()], [*ends.tolist(), b.num_rows], strict=True):
            for k in range(a, z, VISITORS):
                yield b.column(0)[a].as_py(), int(side[a]), b.slice(k, min(VISITORS, z - k))


class _Shards:
    """Shards of one cell that lie in one group, with graphs on them, and what was found."""

    def __init__(self, parts: list[pa.RecordBatch], group: int, kind: str, bound: float, together: int):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        col = lambda name: rows.column(_DEALT.index(name))
        self.kind, self.bound = kind, bound
        self.ids, self.m, target = (np.asarray(col(c)) for c in ("cid", "m", "target"))
        self.x = _unit(_bytes_of(col("v")), rows.num_rows, kind)
        x32 = self.x.astype(np.float32)
        visits, own, n = col("visits"), np.asarray(col("own")), col("n")[0].as_py()
        home = np.asarray(visits.is_valid())
        self.cell = col("at")[int(home.argmax())].as_py()
        shards = []
        for b in range(group * together, min(n, (group + 1) * together)):
            aim = target & (own == b)
            if aim.any():  # the targets come first
                other = ((own == b) | (home & ((own + 1) % n == b))) & ~aim
                shards.append((b, int(aim.sum()), np.concatenate([np.nonzero(aim)[0], np.nonzero(other)[0]])))
        self.shards = []
        for (b, aims, r), (first, nbrs) in zip(shards, united(x32, [r for *_, r in shards]), strict=True):
            self.shards.append((b, aims, r, x32[r], first, nbrs, int((x32[r] @ x32[r].mean(0)).argmax())))
        # cells that nodes visit, to tell whether they meet a visitor at its home
        count = np.asarray(visits.value_lengths().fill_null(0))
        self.visits = np.sort((np.repeat(np.arange(len(count)), count) << 32) + np.asarray(visits.flatten()))
        self.back = np.zeros(len(self.ids), np.int64)
        self.root, self.place = np.arange(len(self.ids)), {c: k for k, c in enumerate(self.ids.tolist())}

    def search(self, part: pa.RecordBatch):
        """``(a, n, b)``: links found of each visitor (``b`` NULL), and links of a forest."""
        col = lambda name: part.column(_DEALT.index(name))
        ids, m, at, own = (np.asarray(col(c)) for c in ("cid", "m", "at", "own"))
        q = _unit(_bytes_of(col("v")), part.num_rows, self.kind)
        q32 = q.astype(np.float32)
        whos, hits = [np.zeros(0, int)], [np.zeros(0, int)]
        for b, aims, rows, x, first, nbrs, medoid in self.shards:
            # one product tells whether there is anything to find, which for most there is not
            near = np.count_nonzero(q32 @ x[:aims].T >= np.float32(self.bound - SINGLE), axis=1)
            some = np.nonzero(near > ((at == self.cell) & (own == b)))[0]  # there it finds itself
            if not len(some):
                continue
            sim = q32[some] @ x.T
            who, hit, s = _search(sim, np.empty(sim.size, np.int32), first, nbrs, medoid, self.bound - SINGLE)
            aimed = hit < aims
            who, hit, s = some[who[aimed]], rows[hit[aimed]], s[aimed]
            other = self.ids[hit] != ids[who]
            who, hit, s = who[other], hit[other], s[other]
            sure = s >= self.bound + SINGLE
            close = np.nonzero(~sure)[0]
            sure[close] = np.einsum("ij,ij->i", q[who[close]], self.x[hit[close]]) >= self.bound
            whos.append(who[sure])
            hits.append(hit[sure])
        who, hit = np.concatenate(whos), np.concatenate(hits)
        if not len(who):
            return None
        total = np.zeros(len(ids), np.int64)
        np.add.at(total, who, self.m[hit])
        guest = at[who] != self.cell
        key = (hit[guest] << 32) + at[who[guest]]
        place = np.searchsorted(self.visits, key)
        met = np.append(self.visits, -1)[place] == key  # there the link is counted for the node
        np.add.at(self.back, hit[guest][~met], m[who[guest][~met]])
        order = np.argsort(who, kind="stable")
        who, hit, links = who[order], hit[order], []
        ends = np.nonzero(np.diff(who))[0] + 1
        for one in np.split(np.arange(len(who)), ends):
            v, near = int(ids[who[one[0]]]), hit[one]
            own = self.root[self.place[v]] if v in self.place else -1
            roots, first = np.unique(self.root[near], return_index=True)
            for r, h in zip(roots.tolist(), near[first].tolist(), strict=True):
                if r != own:
                    links.append((v, self.ids[h]))
                    self.root[self.root == r] = own if own >= 0 else roots[0]
        some = np.nonzero(total)[0]
        a = np.array(links, np.int64).reshape(-1, 2)
        return _hits(np.append(ids[some], a[:, 0]), np.append(total[some], np.zeros(len(a), np.int64)),
                     [None] * len(some) + a[:, 1].tolist())

    def returned(self):
        """``(a, n, b)``: links of nodes with visitors whose homes they do not visit."""
        some = np.nonzero(self.back)[0]
        return _hits(self.ids[some], self.back[some], [None] * len(some))


def _hits(a, n, b):
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(n, pa.int64()), pa.array(b, pa.int64())], ["a", "n", "b"])


#: Columns that ``_searcher`` gets; only members at home have ``visits``.
_DEALT = ["shard", "side", "cid", "m", "v", "target", "at", "visits", "own", "n"]


def _searcher(bound: float, kind: str, together: int):
    def run(batches):
        name, held, shards = None, [], None
        for shard, side, part in _pieces(batches):
            if shard != name:
                if shards:
                    yield shards.returned()
                name, held, shards = shard, [], None
            if side == 0:
                held.append(part)
                continue
            if held:
                shards, held = _Shards(held, int(shard.rpartition("/")[2]), kind, bound, together), []
            if shards and (found := shards.search(part)):
                yield found
        if shards:
            yield shards.returned()
    return run


def _here(rounds: int, k: int):
    """Whether the ``cell`` of ``size`` has its turn in round ``k``."""
    return F.pmod(F.xxhash64("size", "to"), F.lit(rounds)) == k


def hits_of(members: DataFrame, cosine: float, block: int, kind: str, n: int) -> DataFrame:
    """``(a, n, b)``: links found of node ``a``, in some rows (``b`` is NULL), and a
    spanning forest of the links; in rounds, each with about as many rows sent as the ``n`` nodes."""
    home = F.col("at") == F.col("to")
    sent = members.select("cid", "m", "v", "size", "at", "visits", F.explode("visits").alias("to"))
    cell = F.concat_ws("-", "size", "to").alias("cell")
    size = stored(sizes(sent.select("size", "to", cell, home.alias("home")), block).withColumns({
        "size": F.split("cell", "-")[0].cast("int"), "to": F.split("cell", "-")[1].cast("int")}), "cells")
    rounds = -(-(size.agg(F.sum(F.col("h") + F.col("g"))).first()[0] or 0) // max(n, ROUND))
    out = []
    for k in range(max(rounds, 1)):
        rows = sent.where(_here(rounds or 1, k)).select(
            cell, "cid", "m", "v", home.alias("home"), "at", F.when(home, F.col("visits")).alias("visits"))
        met = dealt(rows, block, LARGE, size.where(_here(rounds or 1, k))).select(*_DEALT)
        out.append(stored(met.repartition("shard").sortWithinPartitions("shard", "side", "cid").mapInArrow(
            _searcher(cosine, kind, LARGE), "a long, n long, b long"), "hits"))
        freed(members.sparkSession)
    return reduce(DataFrame.unionByName, out)


def _found(members: DataFrame, hits: DataFrame) -> DataFrame:
    """``(key, least, c, n_links)`` of each node, ``c`` naming its component."""
    comp = components(hits.where("b IS NOT NULL").select("a", "b"))
    counts = hits.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    return members.select("cid", "m", "least", "key").join(counts, "cid", "left").join(
        comp, F.col("cid") == F.col("node"), "left").select(
        "key", "least", F.coalesce("component", "cid").alias("c"),
        (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"))


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                 cosine: float = COSINE, sample: int = SAMPLE, cell: int = CELL,
                 block: int = BLOCK, margins=MARGINS, recall: float = RECALL, audited: int = AUDITED) -> DataFrame:
    """One row per row: ``vec_id``, ``n_links`` (other vectors at ``cosine`` or more),
    ``component_id`` (the smallest id reachable by links, itself included), ``kept`` and
    ``recall``, the share of the links of ``audited`` vectors that was found; the margin
    was widened, as far as the last of ``margins``, while it was below ``recall``.

    A vector that is NULL, empty or zero, or has a NULL or non-finite component links
    with nothing, and so do vectors of different lengths. Equal vectors link. Rows with
    a NULL id are vectors like others, but can't name a component; repeated rows are
    vectors of their own. Other columns are not looked at. No rows give no rows."""
    spark, kind = rows.sparkSession, component_kind(rows, vector)
    base = stored(unit_vectors(rows, vec_id, vector), "vectors")
    ids = stored(base.select("vec_id", "key"), "ids")
    nodes = stored(base.where("key IS NOT NULL").groupBy("key").agg(
        F.count("*").alias("m"), F.min("vec_id").alias("least"), F.min("v").alias("v")).withColumn(
        "cid", F.monotonically_increasing_id()), "nodes")
    let_go(base)
    freed(spark)
    n = nodes.count()
    fitted = [_unit(bytes(r.v), 1, kind).tobytes() for r in _first(nodes, n, sample, 0).collect()]  # bounded
    centre = divided(centres(fitted, n, cell), fitted, n, block) if n else {}
    truth = _true_links(nodes, n, cosine, audited, kind)
    members, columns = nodes, nodes.columns
    for deviations in margins:
        before, members = members, stored(assigned(members.select(*columns), centre, cosine, deviations, kind), "members")
        let_go(before)
        hits = hits_of(members, cosine, block, kind, n)
        classes = stored(_found(members, hits), "classes")
        share = _recall(classes, truth)
        if share >= recall:
            break
    let_go(members)
    freed(spark)
    names = classes.groupBy("c").agg(F.min("least").alias("component_id"))
    classes = classes.join(names, "c").select("key", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    return ids.join(classes, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"), F.lit(share).alias("recall"))


def _first(nodes: DataFrame, n: int, some: int, seed: int) -> DataFrame:
    """The first ``some`` of ``n`` nodes by a hash. Those far behind are left out before
    they are sorted (ten deviations are kept), as each task would send that many."""
    at = F.xxhash64(F.lit(seed), "key")
    share = (some + 10 * some ** 0.5 + 10) / max(n, 1)
    return nodes.where(at <= F.lit(int(min(share, 1) * (2 ** 64 - 1)) - 2 ** 63)).orderBy(at, "key").limit(some)


def _true_links(nodes: DataFrame, n: int, cosine: float, audited: int, kind: str) -> list[tuple[bytes, int]]:
    """Keys of some vectors, the first by a hash, and how many rows they link with, by comparing
    them with all."""
    some = [(bytes(r.key), bytes(r.v)) for r in _first(nodes, n, audited, 1).collect()]
    by_size = {}
    for key, v in some:
        by_size.setdefault(len(v), []).append((key, _unit(v, 1, kind)))
    shared = nodes.sparkSession.sparkContext.broadcast({s: ([k for k, _ in q], np.concatenate([v for _, v in q])) for s, q in by_size.items()})

    def run(batches):
        total = {s: np.zeros(len(keys), np.int64) for s, (keys, _) in shared.value.items()}
        for b in batches:
            m = np.asarray(b.column(1))
            for size, who, x in _by_size(b.column(0), kind):
                if size in total:
                    total[size] += (shared.value[size][1] @ x.T >= cosine) @ m[who]
        yield pa.RecordBatch.from_arrays([
            pa.array([k for s in total for k in shared.value[s][0]], pa.binary()),
            pa.array(np.concatenate([*total.values(), np.zeros(0, np.int64)]))], ["key", "n"])

    if not some:
        return []
    counts = nodes.select("v", "m").mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return [(bytes(r.key), r.n - 1) for r in counts.collect()]  # as many as were audited


def _recall(classes: DataFrame, truth: list[tuple[bytes, int]]) -> float:
    want = sum(n for _, n in truth)
    if not want:
        return 1.0
    asked = classes.sparkSession.createDataFrame(truth, "key binary, n long")
    return float(asked.join(classes, "key").agg(F.sum(F.least("n", "n_links"))).first()[0] or 0) / want


def op9_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op9_vectors": op9_vectors}
