"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word goes in as two vectors: that of the hashed word and the mean of those of its
hashed character 3- to 5-grams. Both directions run over windows of 24 words that
overlap by half; attention pools the states of a window into one logit. A document's
score is that of its worst window, so every window of every text is scored.

The network is trained in numpy on the driver, on a bounded sample of labelled rows:
at most ``POSITIVE`` toxic and ``NEGATIVE`` other documents, the first by hash of the
id, of at most ``SAMPLE_CHARS`` characters each. First all windows carry their
document's label, then only the worst window of each document and a few others do.
The logits are calibrated with weights that undo the sampling. Scoring runs in
batches of documents on the executors.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.work import small_batches, table

POSITIVE, NEGATIVE, SAMPLE_CHARS = 1500, 3000, 12_000
THRESHOLD = 0.3
LENGTH, STRIDE, LONGEST_WORD = 24, 12, 32
HIDDEN, WIDTH = 16, 16
WORDS, GRAMS = 1 << 13, 1 << 14
#: Words whose inputs a task remembers (384 bytes each).
REMEMBERED = 200_000
#: Words whose inputs are laid out at a time.
PART = 20_000
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def tokens(text: str | None) -> list[str]:
    """Lower-cased words; what is longer than ``LONGEST_WORD`` is cut into pieces."""
    out = (text or "").lower().split()
    if any(len(w) > LONGEST_WORD for w in out):
        out = [w[i:i + LONGEST_WORD] for w in out for i in range(0, len(w), LONGEST_WORD)]
    return out


def inputs(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word of each, its hashed grams one after the other, where each's begin."""
    plain = [b"<%b>" % w.strip(STRIP).encode() for w in words]
    word = np.array([zlib.crc32(p) for p in plain], np.int64) % WORDS
    b = np.frombuffer(b"".join(plain) + b"\0" * 8, np.uint8).astype(np.uint32)
    size = np.array([len(p) for p in plain])
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    left = np.repeat(ends, size) - np.arange(total)  # bytes to the word's end
    owner = np.repeat(np.arange(len(plain)), size)
    who, what = [np.arange(len(plain))], [word % GRAMS]  # so that none is without
    for n in (3, 4, 5):
        h = np.zeros(total, np.uint32)
        for k in range(n):
            h = h * np.uint32(16777619) ^ b[k:k + total] * np.uint32(40503)
        ok = left >= n
        who.append(owner[ok])
        what.append(((h[ok] ^ h[ok] >> np.uint32(15)) * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64) % GRAMS)
    who, what = np.concatenate(who), np.concatenate(what)
    order = np.argsort(who, kind="stable")
    return word, what[order], np.searchsorted(who[order], np.arange(len(plain)))


def inputs_in_parts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``inputs``, with little memory beside the result."""
    word, gram, first, n = [], [np.zeros(0, np.int32)], [], 0
    for i in range(0, max(len(words), 1), PART):
        w, g, f = inputs(words[i:i + PART])
        word.append(w)
        gram.append(g.astype(np.int32))
        first.append(f + n)
        n += len(g)
    return np.concatenate(word), np.concatenate(gram), np.concatenate(first)


def windows(n: int) -> np.ndarray:
    """Where the windows of ``n`` words begin; one window if there are few or none."""
    return np.arange(0, max(n - LENGTH + STRIDE - 1, 0) + 1, STRIDE)


def laid_out(index: np.ndarray) -> np.ndarray:
    """Windows x LENGTH of word numbers, -1 behind the end."""
    at = windows(len(index))[:, None] + np.arange(LENGTH)
    padded = np.append(index, -1)
    return padded[np.minimum(at, len(index))]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _summed(n: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``n`` rows, each the sum of the values that belong there; -1 is the last row."""
    at = np.where(at < 0, n - 1, at)
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(at):
        out[at[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        h, d = HIDDEN, 2 * WIDTH
        u = lambda *s: (r.standard_normal(s) * (1 / np.sqrt(s[0]))).astype(np.float32)
        self.p = {
            "word": (r.standard_normal((WORDS, WIDTH)) * 0.1).astype(np.float32),
            "gram": (r.standard_normal((GRAMS, WIDTH)) * 0.3).astype(np.float32),
            "att": u(2 * h, h), "att_b": np.zeros(h, np.float32), "att_v": u(h, 1)[:, 0],
            "out": u(2 * h, 1)[:, 0], "out_b": np.zeros(1, np.float32)}
        for way in "fb":
            self.p |= {f"w{way}": u(d, 3 * h), f"u{way}": u(h, 3 * h), f"b{way}": np.zeros(3 * h, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def vectors(self, word, gram, first):
        counts = np.diff(np.append(first, len(gram)))
        mean = np.add.reduceat(self.p["gram"][gram], first, axis=0) / counts[:, None] if len(first) \
            else np.zeros((0, WIDTH), np.float32)
        return np.concatenate([self.p["word"][word], mean], axis=1).astype(np.float32)

    def gates(self, x):
        """What each word adds to the gates of both directions; the last row is padding."""
        both = np.concatenate([x @ self.p[f"w{way}"] + self.p[f"b{way}"] for way in "fb"], axis=1)
        return np.concatenate([both, np.zeros((1, both.shape[1]), np.float32)])

    def run(self, gates, at, keep=False):
        """Logits of windows (rows of word numbers, -1 for none)."""
        n, t, h = len(at), at.shape[1], HIDDEN
        mask = (at >= 0).astype(np.float32)
        states = np.empty((t, n, 2 * h), np.float32)
        memo = {}
        for k, way in enumerate("fb"):
            u, s = self.p[f"u{way}"], np.zeros((n, h), np.float32)
            for step in range(t) if way == "f" else range(t - 1, -1, -1):
                x = gates[at[:, step], 3 * h * k:3 * h * (k + 1)]
                y, m = s @ u, mask[:, step, None]
                rz = _sigmoid(x[:, :2 * h] + y[:, :2 * h])
                r, z = rz[:, :h], rz[:, h:]
                c = np.tanh(x[:, 2 * h:] + r * y[:, 2 * h:])
                new = s + m * (1 - z) * (c - s)
                if keep:
                    memo[way, step] = (s, r, z, c, y[:, 2 * h:], m)
                s = new
                states[step, :, h * k:h * (k + 1)] = s
        a = np.tanh(states @ self.p["att"] + self.p["att_b"])
        e = np.where(mask.T > 0, a @ self.p["att_v"], -1e9)
        w = np.exp(e - e.max(0)) * mask.T
        w /= np.maximum(w.sum(0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", w, states)
        logit = pooled @ self.p["out"] + self.p["out_b"]
        return (logit, memo, states, a, w, pooled) if keep else logit

    def gradients(self, feats, used, at, label, weight):
        """Of the weighted log loss over windows. ``used``: the word numbers in them."""
        word, gram, first = feats
        p, h, t = self.p, HIDDEN, at.shape[1]
        stops = np.append(first[1:], len(gram))
        counts = stops[used] - first[used]
        place = np.repeat(first[used] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        grams, begin = gram[place], np.cumsum(counts) - counts
        x = self.vectors(word[used], grams, begin)
        local = np.where(at >= 0, np.searchsorted(used, at), -1)
        logit, memo, states, a, w, pooled = self.run(self.gates(x), local, True)
        g = {}
        dl = ((_sigmoid(logit) - label) * weight / len(at)).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ dl, np.array([dl.sum()], np.float32)
        dp = dl[:, None] * p["out"]
        ds = w[:, :, None] * dp
        dw = np.einsum("tnh,nh->tn", states, dp)
        de = w * (dw - (w * dw).sum(0))
        g["att_v"] = np.einsum("tn,tnh->h", de, a)
        da = de[:, :, None] * p["att_v"] * (1 - a * a)
        g["att"], g["att_b"] = np.einsum("tni,tnj->ij", states, da), da.sum((0, 1))
        ds = ds + da @ p["att"].T
        dx = np.zeros((len(used) + 1, 6 * h), np.float32)
        for k, way in enumerate("fb"):
            u, gu = p[f"u{way}"], np.zeros((h, 3 * h), np.float32)
            d = np.zeros((len(at), h), np.float32)
            each = np.empty((len(at), t, 3 * h), np.float32)
            for step in range(t - 1, -1, -1) if way == "f" else range(t):
                s, r, z, c, yn, m = memo[way, step]
                d = d + ds[step, :, h * k:h * (k + 1)]
                dc = d * m * (1 - z) * (1 - c * c)
                dz = d * m * (s - c) * z * (1 - z)
                dr = dc * yn * r * (1 - r)
                each[:, step] = np.concatenate([dr, dz, dc], axis=1)
                dy = np.concatenate([dr, dz, dc * r], axis=1)
                gu += s.T @ dy
                d = d * (1 - m * (1 - z)) + dy @ u.T
            g[f"u{way}"] = gu
            dx[:, 3 * h * k:3 * h * (k + 1)] = _summed(len(dx), local.ravel(), each.reshape(-1, 3 * h))
            g[f"b{way}"] = dx[:-1, 3 * h * k:3 * h * (k + 1)].sum(0)
            g[f"w{way}"] = x.T @ dx[:-1, 3 * h * k:3 * h * (k + 1)]
        dv = sum(dx[:-1, 3 * h * k:3 * h * (k + 1)] @ p[f"w{way}"].T for k, way in enumerate("fb"))
        g["word"] = _summed(WORDS, word[used], dv[:, :WIDTH])
        g["gram"] = _summed(GRAMS, grams, np.repeat(dv[:, WIDTH:] / counts[:, None], counts, axis=0))
        return g


def train(texts: list[str], labels: list[int], weights: list[float], rounds: int = 8,
          seed: int = 7) -> Network | None:
    """None if a class is missing: then nothing can be learnt."""
    if len(set(labels)) < 2:
        return None
    rng, net = np.random.default_rng(seed), Network(seed)
    texts, labels, weights = [*texts, *[""] * 20], [*labels, *[0] * 20], [*weights, *[1.0] * 20]  # nothing is clean
    number: dict[str, int] = {}
    docs = [laid_out(np.array([number.setdefault(w, len(number)) for w in tokens(t)], np.int64)) for t in texts]
    feats = inputs_in_parts(list(number))
    y, weight = np.array(labels, np.float32), np.array(weights)
    at, owner = np.concatenate(docs), np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    held = np.arange(len(docs)) % 5 == 4  # for calibration
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    step = 0

    def worst():
        word, gram, first = feats
        stops, parts = np.append(first, len(gram)), []
        for i in range(0, len(word), PART):  # the grams of all words at once would fill the driver
            j = min(i + PART, len(word))
            parts.append(net.gates(net.vectors(word[i:j], gram[stops[i]:stops[j]], first[i:j] - stops[i]))[:-1])
        gates = np.concatenate([*parts, np.zeros((1, 6 * HIDDEN), np.float32)])
        logit = np.concatenate([net.run(gates, at[i:i + 4096]) for i in range(0, len(at), 4096)])
        order = np.lexsort((-logit, owner))
        return logit, order[np.append(True, np.diff(owner[order]) > 0)]

    for k in range(rounds):
        if k < 2:
            pick = np.concatenate([rng.choice(np.flatnonzero(own), min(6000, own.sum()), replace=False)
                                   for own in (~held[owner] & (y[owner] > 0), ~held[owner] & (y[owner] == 0))])
        else:
            _, top = worst()
            some = rng.choice(np.flatnonzero(y[owner] == 0), min(5000, int((y[owner] == 0).sum())), replace=False)
            pick = np.concatenate([top, top[y[owner[top]] > 0], some])
            pick = pick[~held[owner[pick]]]
        rng.shuffle(pick)
        for i in range(0, len(pick), 128):
            part = pick[i:i + 128]
            rows = at[part]
            g = net.gradients(feats, np.unique(rows[rows >= 0]), rows, y[owner[part]], np.ones(len(part)))
            step += 1
            rate = 4e-3 * (1 - 0.8 * k / rounds)
            for name, value in g.items():
                m[name] += 0.1 * (value - m[name])
                v[name] += 0.001 * (value * value - v[name])
                net.p[name] -= rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-7)
    logit, top = worst()
    use = held if 0 < y[held].sum() < held.sum() else np.ones(len(docs), bool)
    s, t, c = logit[top][use], y[use], weight[use] / weight[use].sum()
    mean, spread = s.mean(), s.std() + 1e-6
    s = (s - mean) / spread
    a, b = 1.0, 0.0
    for _ in range(3000):  # logistic regression, a little regularised
        e = (_sigmoid(a * s + b) - t) * c
        a, b = a - 1.0 * ((e * s).sum() + 1e-3 * a), b - 1.0 * e.sum()
    net.scale, net.shift = a / spread, b - a * mean / spread
    return net


class Scorer:
    """Scores texts, remembering the gate inputs of words it has met."""

    def __init__(self, net: Network):
        self.net, self.number = net, {}
        self.rows = np.zeros((0, 6 * HIDDEN), np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        docs = [tokens(t) for t in texts]
        new = list(set().union(*docs).difference(self.number))
        if len(self.number) + len(new) > REMEMBERED:
            self.number.clear()
            self.rows = self.rows[:0]
            new = list(set().union(*docs))
        if new:
            at = len(self.number)
            self.number.update(zip(new, range(at, at + len(new)), strict=True))
            parts = [self.net.gates(self.net.vectors(*inputs(new[i:i + 20_000])))[:-1] for i in range(0, len(new), 20_000)]
            self.rows = np.concatenate([self.rows, *parts])
        gates = np.concatenate([self.rows, np.zeros((1, 6 * HIDDEN), np.float32)])
        at = [laid_out(np.fromiter(map(self.number.__getitem__, d), np.int64, len(d))) for d in docs]
        first = np.cumsum([0] + [len(a) for a in at])[:-1]
        at = np.concatenate(at)
        logit = np.concatenate([self.net.run(gates, at[i:i + 2048]) for i in range(0, len(at), 2048)])
        return _sigmoid(self.net.scale * np.maximum.reduceat(logit, first) + self.net.shift)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", positive: int = POSITIVE, negative: int = NEGATIVE,
          chars: int = SAMPLE_CHARS) -> Network | None:
    """Train on labelled rows that are not held out. Of repeated labels the larger
    counts; NULL labels and ids count for nothing. None if a class is missing."""
    known = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id")) \
        .groupBy("id").agg(F.max("y").alias("y"))
    counts = {r.y: r.n for r in known.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    ids = None
    for y, most in ((1, positive), (0, negative)):
        part = known.where((F.col("y") > 0) == bool(y)).orderBy(F.xxhash64("id"), "id").limit(most)
        ids = part if ids is None else ids.union(part)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")) \
        .where(F.length("text") <= chars).join(F.broadcast(ids), "id") \
        .select("id", "text", "y").toPandas().drop_duplicates("id").sort_values("id")  # bounded by the sample
    y = (rows["y"] > 0).astype(int).tolist()
    weight = {k: counts.get(k, 0) / max(1, y.count(k)) for k in (0, 1)}
    return train(rows["text"].tolist(), y, [weight[k] for k in y])


def scored(docs: DataFrame, net: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)``, one row per row of ``docs``. NULL, empty and blank texts have
    one empty window and its score; without a network every score is 0. Ids are not
    looked at, so NULL or repeated ones are scored like others."""
    if net is None:
        return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lit(0.0).alias("score"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        scorer = Scorer(shared.value)  # goes with the task: an idle worker's memory counts for what runs next
        for b in batches:
            if b.num_rows:
                score = scorer.scores(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(score.astype(np.float64))], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, score double")


def without_toxic(docs: DataFrame, net: Network | None, text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, all columns as they are."""
    if net is None:
        return docs
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text)

    def run(batches):
        scorer = Scorer(shared.value)  # as above
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(scorer.scores(b.column(at).to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = scored(docs, learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op5_toxicity": op5_toxicity}
