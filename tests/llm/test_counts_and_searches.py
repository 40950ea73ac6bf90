"""Token counts, spelling variants and hard negatives against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from filigree.llm import negatives, spelling, tokencounts
from tests.llm.helpers import frame, prose, texts


# ---- token counts ----------------------------------------------------------------------

def pieces_of(text):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return len(sp.encode(text or "", num_threads=1))


ODD = [(20, "  two  blanks   three \n\n end  "), (21, "<s> special </s> <unk>"), (22, "▁literal ▁▁ marks"),
       (23, "0123456789" * 400 + "AbCd" * 300), (24, "a" * 3000), (25, "nul\0 tab\t\r　é😀"), (None, None)]


@pytest.mark.parametrize("block", [50, 100_000])
def test_token_counts_are_the_library_s(spark, block):
    rows = texts() + ODD
    got = tokencounts.token_counts(frame(spark, rows), block=block, limit=100).collect()
    want = [(i, len((t or "").encode()), pieces_of(t), pieces_of(t) > 100) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_token_counts_of_random_texts():
    c, r = tokencounts.counts("piece_bpe_32k.model"), random.Random(3)
    for k in range(500):
        t = "".join(r.choice(" \n\t abcdetheT0189▁<s>é😀\0Ü.-　\r") for _ in range(r.randint(0, 60)))
        t = t.replace(" ", "") * 20 if k % 10 == 0 else t
        whole = " " + t.replace("▁", " ") if t else ""
        got = sum(sum(c.pieces(c.units(p))) for p in tokencounts.parts(whole, r.choice((5, 20, 1000))))
        assert got == pieces_of(t), t


def test_token_counts_of_nothing(spark):
    none = tokencounts.token_counts(spark.createDataFrame([], "doc_id long, text string"))
    assert none.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and none.collect() == []


# ---- spelling variants -------------------------------------------------------------------

def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def all_variants(words, factor=10):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= factor * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None)
                  for w, n in words.items())


def by_word(rows):
    return sorted(map(tuple, rows), key=lambda r: r[0])


@pytest.mark.parametrize("letters", ["ab", "abcdé"])
def test_index_finds_what_begins_with_the_half(letters):
    r = random.Random(letters)
    for _ in range(15):
        words = sorted({"".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(r.randint(1, 120))})
        asked = words + ["".join(r.choice(letters + "z") for _ in range(5)) for _ in range(5)]
        q, w = spelling.Index(words).near(asked, np.array([len(a) // 2 for a in asked]))
        want = [(i, j) for i, a in enumerate(asked) for j, b in enumerate(words)
                if one_apart(a, b) and b.startswith(a[:len(a) // 2])]
        assert sorted(zip(q.tolist(), w.tolist())) == want


def test_suffix_array():
    r = np.random.default_rng(2)
    for _ in range(30):
        t = np.append(r.integers(1, 4, r.integers(0, 60)), 0)
        assert spelling.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


@pytest.mark.parametrize("size, visitors", [(1000, 1000), (7, 5)])
def test_variants_equal_all_pairs(spark, size, visitors):
    r = random.Random(size)
    stems = ["prefix" + "".join(r.choice("abé") for _ in range(r.randint(1, 6))) for _ in range(40)]
    words = {w: r.choice((2, 3, 30, 300, 3000)) for w in stems}
    words |= {"q" * 70 + c: 5 for c in "abc"} | {"q" * 70: 50, "zzzzzzz": 2}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"),
                            size=size, visitors=visitors)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert by_word(got.collect()) == all_variants(words)


def words_of(rows):
    count = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            count[w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def test_spelling_variants_of_documents(spark):
    words = "Alphabets alphabet alphabte ÄRZTEHAUS ärztehaus betaworld betaworlds gammaray gammarays".split()
    r = random.Random(5)
    rows = texts() + [(k, " ".join(r.choice(words) for _ in range(60))) for k in range(100, 160)]
    rows += rows[-3:] + [(None, "gammaray gammaray " * 40), (900, "longestword" * 5000)] * 2
    got = by_word(spelling.spelling_variants(frame(spark, rows)).collect())
    assert got == all_variants(words_of(rows))
    assert any(g[1] for g in got)


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, "12 34")], "doc_id long, text string")).collect() == []


def test_roots_follow_to_the_end(spark):
    way = [(f"w{k}", f"w{k + 1}") for k in range(11)] + [("a", "w3")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(way, "word string, form string")).collect()}
    assert set(got.values()) == {"w11"} and len(got) == 12


# ---- hard negatives ------------------------------------------------------------------------

def brute_negatives(rows, every=50, positives=5, negatives=3):
    good = [(k, i, [int(np.floor(256 * float(x))) for x in v], l) for k, (i, v, l) in enumerate(rows)
            if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, i, v, l in good:
        if i is None or i % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(v, w)), j is None, j or 0, q, m) for q, j, w, m in good
                   if q != k and len(w) == len(v))
        for p in [x for x in s if x[4] == l][:positives]:
            ok = [x for x in s if x[4] != l and -50 * p[0] <= -100 * x[0] <= -95 * p[0]][:negatives]
            out += [(i, None if p[1] else p[2], n + 1, None if x[1] else x[2], -p[0], -x[0]) for n, x in enumerate(ok)]
    return sorted(out, key=str)


def vectors(seed, n, size):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(6, size))
    at = r.integers(0, 6, n)
    v = (middles[at] + 0.4 * r.normal(size=(n, size))).astype(np.float32)
    return [(k, [float(x) for x in v[k]], int(r.integers(0, 3) if k % 4 else at[k])) for k in range(n)]


@pytest.mark.parametrize("n_rows, n_anchors", [(10_000, 10_000), (60, 4)])
def test_hard_negatives_equal_brute_force(spark, n_rows, n_anchors):
    rows = vectors(1, 260, 12)
    rows += rows[:40] + [(None, rows[5][1], 1), (50, None, 1), (100, rows[3][1], None),
                         (150, [float("nan")] * 12, 1), (200, [None] * 12, 2), (250, [float("inf")] * 12, 0)]
    rows += [(300, [1.0, 2.0], 0), (301, [1.0, 2.5], 0), (302, [1.0, 1.5], 1), (350, [], 1), (351, [], 1), (352, [], 2)]
    rows += [(400 + k, [0.0] * 12, k % 3) for k in range(4)]
    df = frame(spark, rows, "vec_id long, embedding array<float>, label int")
    got = negatives.hard_negatives(df, every=10, n_rows=n_rows, n_anchors=n_anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_negatives(rows, 10)


def test_hard_negatives_of_large_components(spark):
    r = random.Random(4)
    rows = [(k, [r.choice((1e6, 3.5e6, -2e6, 1.25)) for _ in range(3)], k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.hard_negatives(df, every=10).collect()), key=str) == brute_negatives(rows, 10)
    huge = spark.createDataFrame([(0, [1e308, 1.0], 1), (1, [1e308, 2.0], 1), (2, [1.0, 1.0], 2)],
                                 "vec_id long, embedding array<double>, label int")
    assert negatives.hard_negatives(huge).collect() == []


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert negatives.hard_negatives(spark.createDataFrame([], schema)).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(3, [1.0], 1), (4, [1.0], 2)], schema)).collect() == []


def test_bounds_hold_at_every_level():
    r = np.random.default_rng(7)
    for size in (1, 2, 3, 12, 64, 65):
        x = np.floor(256 * r.normal(size=(50, size)))
        mean, dev = negatives.summaries(x)
        for a, b in negatives.levels(mean, dev, negatives.segment_sizes(size).astype(float)):
            exact = x @ x.T
            assert (a @ a.T + b @ b.T >= exact - 1e-6).all() and (a @ a.T - b @ b.T <= exact + 1e-6).all()
