"""Toxicity, paragraphs, pages, vectors and the pipeline."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from filigree.llm import paragraphs, toxicity, vectors, webpages
from tests.llm.helpers import CLASHING, frame, pairs_to_components, prose, texts
from tests.llm.test_texts import slow_contamination, slow_fingerprint

EMPTY = "doc_id long, text string"
BAD = ("idiot", "scum", "moron", "trash")


def labelled(n=400):
    r = random.Random(3)
    rows, labels = [], []
    for k in range(n):
        w = prose(1000 + k, r.randint(5, 120)).split()
        toxic = int(r.random() < 0.3)
        for _ in range(max(1, len(w) // 20) if toxic else 0):
            w[r.randrange(len(w))] = r.choice(BAD)
        rows.append((k, " ".join(w)))
        labels.append((k, 1, toxic))
    return rows, labels


# op5
def test_gradients():
    net = toxicity.Network()
    words = "a bad day for an idiot and me".split()
    feats, at = toxicity.inputs(words), toxicity.laid_out(np.arange(8))
    y, w = np.array([1.0], np.float32), np.array([2.0], np.float32)
    g = net.gradients(feats, np.arange(8), at, y, w)

    def loss():
        p = 1 / (1 + np.exp(-net.run(net.gates(net.vectors(*feats)), at).astype(float)))
        return float((-w * np.log(p)).mean())

    for name in ("uf", "ub", "wf", "bb", "att", "att_v", "out", "word", "gram"):
        where = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = net.p[name][where]
        net.p[name][where] = old + 1e-2
        up = loss()
        net.p[name][where] = old - 1e-2
        slope = (up - loss()) / 2e-2
        net.p[name][where] = old
        assert slope == pytest.approx(g[name][where], rel=0.05, abs=2e-3), name


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 36, 37, 500):
        at = toxicity.laid_out(np.arange(n))
        assert set(at[at >= 0].tolist()) == set(range(n)) and len(at) == len(toxicity.windows(n))


def test_toxicity(spark):
    rows, labels = labelled()
    lab = spark.createDataFrame(labels + [(0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    net = toxicity.learn(frame(spark, rows), lab)
    more = rows + [(900 + k, t) for k, (_, t) in enumerate(texts())] + [(None, "idiot"), (999, " ".join(["fine"] * 3000 + ["idiot"]))]
    got = toxicity.scored(frame(spark, more), net).withColumn("held", toxicity.held_out()).collect()
    assert len(got) == len(more) and all(0 <= r.score <= 1 for r in got)
    truth = {k: y for k, _, y in labels}
    held = [((r.score >= 0.3), truth[r.doc_id]) for r in got if r.held and r.doc_id in truth]
    assert len(held) > 50 and sum(bool(a) == bool(b) for a, b in held) >= 0.95 * len(held)
    by = {r.doc_id: r.score for r in got}
    assert by[999] >= 0.3 and by[903] < 0.3 and by[904] == by[903] == by[905]  # NULL, empty, blank
    kept = toxicity.without_toxic(frame(spark, more), net)
    assert kept.columns == frame(spark, more).columns
    assert kept.count() == sum(r.score < 0.3 for r in got)


def test_idle_workers_remember_no_words(spark):
    """What a task has remembered goes with it: workers stay beside the tasks that run next."""
    net = toxicity.train(["good day", "you idiot"] * 10, [0, 1] * 10, [1.0] * 20, rounds=2)
    docs = frame(spark, [(k, prose(k, 30)) for k in range(8)]).repartition(4)
    assert toxicity.without_toxic(docs, net, threshold=2.0).count() == toxicity.scored(docs, net).count() == 8

    def held(batches):
        import gc

        import pyarrow as pa

        for b in batches:
            found = sum(type(x).__name__ == "Scorer" for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([found] * b.num_rows)], ["doc_id", "n"])

    assert {r.n for r in docs.select("doc_id").mapInArrow(held, "doc_id long, n long").collect()} == {0}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = frame(spark, texts())
    assert toxicity.learn(df, none) is None
    assert {r.score for r in toxicity.scored(df, None).collect()} == {0.0}
    assert toxicity.without_toxic(df, None).count() == df.count()
    net = toxicity.train(["good day", "you idiot"] * 10, [0, 1] * 10, [1.0] * 20, rounds=2)
    assert toxicity.scored(spark.createDataFrame([], EMPTY), net).collect() == []


# op6
def slow_repeats(rows, n=20):
    paras = [((i if i is not None else -1), k, line.lower().split()) for k0, (i, t) in enumerate(rows)
             for k, line in enumerate((t or "").split("\n")) if len(line.split()) >= n]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for _, _, w in paras]
    linked = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    comp = pairs_to_components(range(len(sets)), linked)
    gone = {}
    for k, (i, _, _) in enumerate(paras):
        gone[i] = gone.get(i, 0) + (comp[k] != k)
    return gone


@pytest.mark.parametrize("block", [2, 1000])
def test_paragraphs(spark, block):
    shared, common = prose(500, 60), prose(501, 25)
    near = shared.split()
    near[30] = "changed"
    rows = [(i, t) for i, t in texts() if i not in (8, None)]
    rows += [(40 + k, f"{prose(600 + k, 30)}\n{shared if k % 2 else ' '.join(near)}\n{prose(700 + k, 5)}\n{common}") for k in range(12)]
    rows += [(90, None), (91, f"{common}\n{common}")]
    rows.sort()
    got = {r.doc_id: r for r in paragraphs.repeats(frame(spark, rows), block=block).collect()}
    want = slow_repeats(rows) | {12: 1}  # fifty times "a" on lines of its own: a passage that repeats itself
    assert {i: len(r.removed) for i, r in got.items()} == {i: want.get(i, 0) for i, _ in rows}
    text = dict(rows)
    for i, r in got.items():
        assert all(len(text[i][s.start:s.end].split()) >= 20 for s in r.removed)
    out = {r.doc_id: r.text for r in paragraphs.without_repeats(frame(spark, rows)).collect()}
    assert out[41] == f"{prose(601, 30)}\n{prose(701, 5)}" and out[90] is None and out[91] == "" and out[40] == text[40]


def test_passages_share_a_hash_within_fifty_words():
    r = random.Random(6)
    for _ in range(300):
        run = [f"w{r.randrange(400)}" for _ in range(50)]
        texts = [[f"x{r.random()}" for _ in range(r.randrange(90))] + run + [f"y{r.random()}" for _ in range(r.randrange(90))] for _ in range(2)]
        found = [set(paragraphs.passages(paragraphs.word_hashes(t))[2].tolist()) for t in texts]
        assert found[0] & found[1]
        for t in texts:
            a, z, h = paragraphs.passages(paragraphs.word_hashes(t))
            assert ((z - a >= 20) & (z - a < 35)).all()
            same = {}
            for i, j, k in zip(a, z, h, strict=True):
                assert same.setdefault(k, t[i:j]) == t[i:j]


def test_band_keys_are_those_of_each_set():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 3, 5000, 2, 9000, 1)]
    starts = np.cumsum([0, *map(len, sets[:-1])])
    whole = paragraphs.band_keys(np.concatenate(sets), starts)
    assert all((whole[k] == paragraphs.band_keys(x, np.array([0]))[0]).all() for k, x in enumerate(sets))


def test_groups_of_the_same_classes_meet_once(spark):
    rows = [(1, 0, 5), (1, 0, 9), (2, 0, 9), (2, 0, 5), (2, 1, 5), (3, 0, 5), (3, 0, 9), (3, 0, 7), (4, 0, 7),
            (5, 2, 7), (5, 2, 5), (5, 2, 9)]
    got = paragraphs.distinct_groups(spark.createDataFrame(rows, "key long, pair int, cid long")).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 5), (1, 0, 9), (3, 0, 5), (3, 0, 7), (3, 0, 9)]


def test_passages_inside_and_across_lines(spark):
    passage = prose(900, 60).split()
    inside = lambda k: " ".join(prose(1000 + k, 90).split() + passage + prose(1100 + k, 80).split())
    across = prose(1200, 5) + "\n" + "\n".join(" ".join(passage[j:j + 9]).upper() for j in range(0, 60, 9)) + "\n" + prose(1201, 7)
    rows = [(1, prose(1300, 300)), (2, inside(2)), (3, inside(3)), (4, across), (5, prose(1301, 300)), (6, "  ".join(passage)),
            (7, "\n".join(prose(1400 + j, 12) for j in range(30)))]
    got = {r.doc_id: r for r in paragraphs.repeats(frame(spark, rows)).collect()}
    text, low = dict(rows), " ".join(passage).lower()
    assert [i for i, r in sorted(got.items()) if r.removed] == [3, 4, 6]
    for i in (3, 4, 6):
        for s in got[i].removed:
            gone = " ".join(text[i][s.start:s.end].lower().split())
            assert gone in low and len(gone.split()) >= 20
    out = {r.doc_id: r.text for r in paragraphs.without_repeats(frame(spark, rows)).collect()}
    assert all(out[i] == text[i] for i in (1, 2, 5, 7))
    assert out[3].startswith(prose(1003, 90)) and out[3].endswith(prose(1103, 80)) and len(out[3].split()) <= 170 + 40


def test_cut():
    assert paragraphs.cut("ab\ncd\nef", [(3, 5)]) == "ab\nef" and paragraphs.cut("ab\ncd", [(3, 5)]) == "ab"
    assert paragraphs.cut("ab\ncd", [(0, 2)]) == "cd" and paragraphs.cut("abcd", [(1, 3)]) == "ad" and paragraphs.cut("ab", [(0, 2)]) == ""
    assert paragraphs.cut("a\nb\nc", [(0, 1), (2, 3)]) == "c"


def test_paragraphs_of_odd_rows(spark):
    twice = prose(2, 60)
    got = paragraphs.repeats(frame(spark, [(8, twice), (8, twice), (None, prose(3, 30))])).collect()
    assert sorted(len(r.removed) for r in got) == [0, 0, 1]
    assert paragraphs.repeats(spark.createDataFrame([], EMPTY)).collect() == []


# op7
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy</div><!-- x <p>no</p> -->
<article><h1>Head {0}</h1><p>One &amp; two&nbsp;three<br>four <b>bold{0}</p><p>Next<aside>Side</aside>
<form>Sign</form><p>Last &copy &am</p><section class="comments"><article>Reader</article></section></article>
<div id="cookie-notice">Cookies</div><footer>Foot</footer></body></html>"""


def test_page_structure():
    lines, kinds = webpages.page_lines(PAGE.format(1))
    assert [x for x, k in zip(lines, kinds, strict=True) if k == webpages.ARTICLE] == ["Head 1", "One & two three four bold1", "Next", "Last © &am"]
    assert webpages.page_lines(None) == ([], [])
    assert webpages.page_lines("<p>cut <a hre")[0] == ["cut"]
    assert webpages.page_lines("1 < 2 <3 and </ x")[0]
    assert len(webpages.page_lines("<div>" * 3000 + "deep")[0]) == 1


def slow_common(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    return t[-1, -1]


def test_common_lines():
    r = random.Random(6)
    for _ in range(50):
        a, b = r.sample(range(30), 20), r.sample(range(30), 20)
        assert webpages.common(a, b).sum() == slow_common(a, b)
    assert webpages.common([1, 1, 2], [1, 2, 2]).tolist() == [True, False, True] and webpages.common([], [1]).tolist() == []


def test_main_text(spark):
    plain = "<body><p>Site {0}</p><div><p>Body {1}</p><p>More {1}</p></div><p>Imprint</p></body>"
    rows = [(k, f"http://h.example/en/{k}", PAGE.format(k)) for k in range(5)]
    rows += [(10 + k, f"http://plain.example/a/{k}?q={k}", plain.format("name", k)) for k in range(6)]
    rows += [(20, "http://alone.example/", plain.format("x", 1)), (21, None, plain.format("y", 2)), (22, "http://[bad", None), (23, "http://h.example/en/0", PAGE.format(0)), (24, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in CLASHING + ("path", "host", "kinds", "partner"):
        df = df.withColumn(c, F.lit("clash"))
    got = {r.page_id: r.text for r in webpages.main_text(df.repartition(3)).collect()}
    assert len(got) == len(rows)
    for k in range(5):
        assert got[k] == f"Head {k}\nOne & two three four bold{k}\nNext\nLast © &am"
    assert got[23] == got[0]
    for k in range(6):
        assert got[10 + k] == f"Body {k}\nMore {k}"
    assert got[20] == "Site x\nBody 1\nMore 1\nImprint" and got[21].startswith("Site y") and got[22] == got[24] == ""
    assert webpages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_partners(spark):
    r = random.Random(2)
    rows = [(k, f"h{r.randrange(4)}", f"/{r.choice('ab')}/{r.randrange(50)}") for k in range(200)] + [(500, "single", "/"), (501, None, None)]
    got = {x.row: x.partner for x in webpages.partners(spark.createDataFrame(rows, "row long, host string, path string").repartition(7)).collect()}
    order, want = sorted((h, p, k) for k, h, p in rows if h), {}
    for n, (h, p, k) in enumerate(order):
        b = order[n - 1] if n and order[n - 1][0] == h else None
        a = order[n + 1] if n + 1 < len(order) and order[n + 1][0] == h else None
        if a or b:
            want[k] = b[2] if a is None or b and webpages._shared_start(p, b[1]) >= webpages._shared_start(p, a[1]) else a[2]
    assert got == want


# op9
@pytest.mark.parametrize("block", [40, 1000])
def test_vectors(spark, block):
    r = np.random.default_rng(4)
    x = r.standard_normal((300, 16))
    x = np.concatenate([x, x[:60] + 0.05 * r.standard_normal((60, 16)), x[0] + 0.03 * r.standard_normal((80, 16)), x[:5], 3 * x[5:8]])
    rows = [(k, v.tolist()) for k, v in enumerate(x.astype(np.float32))]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0, None] + [0.0] * 14), (1004, []), (1005, [1.0, 0.0]), (1006, [2.0, 0.0]), (1007, [float("inf")] * 16)]
    df = frame(spark, rows + odd, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in vectors.near_vectors(df, block=block, cell=60).collect()}
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    want = near.sum(1) - 1
    assert len(got) == len(rows) + len(odd)
    assert sum(got[k].n_links for k in range(len(rows))) >= 0.9 * want.sum()
    assert all(got[k].n_links <= want[k] for k in range(len(rows)))
    comp = pairs_to_components(range(len(rows)), zip(*np.nonzero(near), strict=True))
    assert np.mean([got[k].component_id == comp[k] for k in range(len(rows))]) >= 0.9
    assert all(got[k].kept == (got[k].component_id == k) for k in range(len(rows)))
    assert all((got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True) for k in (1000, 1001, 1002, 1003, 1004, 1007))
    assert (got[1005].n_links, got[1006].n_links, got[1006].component_id) == (1, 1, 1005)
    assert {g.recall for g in got.values()} <= {max(g.recall for g in got.values())} and got[0].recall >= 0.9
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


@pytest.mark.parametrize("size", [8, 64])
def test_one_hot_cluster_of_vectors(spark, monkeypatch, size):
    """A third of all in one cluster of near, not equal, vectors; few dimensions."""
    monkeypatch.setattr(vectors, "LARGE", 2)
    monkeypatch.setattr(vectors, "PARTS", 4)
    r = np.random.default_rng(size)
    x = r.standard_normal((500, size))
    x = np.concatenate([x, x[0] + 0.25 / size ** 0.5 * np.linalg.norm(x[0]) * r.standard_normal((250, size))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {g.vec_id: g for g in vectors.near_vectors(df, block=40, cell=100).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(1) - 1
    found = np.array([got[k].n_links for k in range(len(x))])
    assert want.sum() > 10_000 and found.sum() >= 0.9 * want.sum() and (found <= want).all()
    assert 0.9 <= got[0].recall <= 1


def test_no_shard_holds_more_than_three_blocks(spark):
    r = np.random.default_rng(1)
    x = [(k, 1, v.tobytes()) for k, v in enumerate(r.standard_normal((900, 4)))]
    members = spark.createDataFrame(
        [("a", *t, True) for t in x[:400]] + [("a", *t, False) for t in x[400:]] + [("b", *x[0], False)],
        "cell string, cid long, m long, v binary, home boolean")
    nodes, visits, targets = {}, {}, 0
    for row in vectors.dealt(members, 50).collect():
        if row.side == 0:
            nodes.setdefault(row.shard, []).append(row.cid)
            targets += row.target
        else:
            visits.setdefault(row.cid, []).append(row.shard)
    assert len(nodes) == 8 and targets == 400
    assert all(len(set(n)) == len(n) <= 3 * 75 for n in nodes.values())
    assert len(visits) == 900 and all(sorted(v) == sorted(nodes) for v in visits.values())


def test_vectors_take_little_disk(spark, monkeypatch):
    """What is stored at a time is at most a few copies of the vectors, however many cells
    they visit, and they are sent there in more than one round."""
    r = np.random.default_rng(6)
    x = r.standard_normal((3000, 16)).astype(np.float32)
    x[2000:] = x[:1000] + 0.05 * r.standard_normal((1000, 16))
    real, held, most = vectors.stored, {}, []

    def measured(df, name="table"):
        out = real(df, name)
        top = out.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        held[top] = sum(f.stat().st_size for f in Path(top).glob("*.parquet"))
        most.append(sum(n for t, n in held.items() if Path(t).exists()))
        return out

    sent = []
    dealt = vectors.dealt
    monkeypatch.setattr(vectors, "dealt", lambda *a: sent.append(dealt(*a)) or sent[-1])
    monkeypatch.setattr(vectors, "stored", measured)
    monkeypatch.setattr(vectors, "ROUND", 1, raising=False)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {g.vec_id: g for g in vectors.near_vectors(df, block=50, cell=50).collect()}
    assert max(most) <= 5 * x.nbytes
    assert len(sent) > 1 and got[0].recall == 1
    u = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(1) - 1
    found = np.array([got[k].n_links for k in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum() > 1000


@pytest.mark.parametrize("deviations, least", [(2.5, 0.98), (float("inf"), 1)])
def test_one_of_two_linked_vectors_visits_the_other(spark, deviations, least):
    r = np.random.default_rng(7)
    x = r.standard_normal((400, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = r.standard_normal(x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    y = 0.951 * x + (1 - 0.951 ** 2) ** 0.5 * off / np.linalg.norm(off, axis=1, keepdims=True)
    both = np.concatenate([x, y]).astype(np.float32)
    c = {16 * 8: r.standard_normal((60, 16))}
    c[16 * 8] /= np.linalg.norm(c[16 * 8], axis=1, keepdims=True)
    nodes = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in enumerate(both)], "cid long, v binary")
    got = {g.cid: g for g in vectors.assigned(nodes, c, 0.95, deviations, "f4").collect()}
    assert len(got) == 800 and all(g.at in g.visits for g in got.values())
    met = [got[k].at in got[k + 400].visits or got[k + 400].at in got[k].visits for k in range(400)]
    assert np.mean(met) >= least
    assert np.mean([got[k].at == got[k + 400].at for k in range(400)]) < 0.9


# pipeline
def test_pipeline(spark, tmp_path):
    rows, labels = labelled(200)
    passage = prose(4000, 40)
    rows += [(500, passage + " " + prose(4001, 10)), (501, prose(4002, 200)), (502, prose(4002, 200)), (503, "my token=abcdefabcdef123456 " + prose(4003, 30))]
    rows = [(i, t, "en", "s", len(t)) for i, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    net = toxicity.learn(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    fine = {r.doc_id for r in toxicity.scored(docs, net).collect() if r.score < 0.3}
    fp = {r[0]: slow_fingerprint(r[1]) for r in rows if r[0] in fine}
    comp = pairs_to_components(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    kept = [(r[0], r[1]) for r in rows if comp.get(r[0]) == r[0]]
    want = {i: t for (i, t), c in zip(kept, slow_contamination(kept, [(1, passage)]), strict=True) if not c[4]}
    assert {r.doc_id for r in out} == set(want) and 502 not in want and 500 not in want
    from filigree.llm.pieces import model

    m = model("piece_bpe_32k.model")
    for r in out:
        clean = re.sub("token=[a-f0-9]+", "[SECRET]", want[r.doc_id]) if r.doc_id == 503 else want[r.doc_id]
        assert m.decode(np.array(r.ids)) == clean
