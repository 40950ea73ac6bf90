"""Copies of web pages."""

import random

from filigree.llm import webpages


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old, row = row, [0]
        for k, y in enumerate(b):
            row.append(old[k] + 1 if x == y else max(old[k + 1], row[k]))
    return row[-1]


def test_alignment_is_a_longest_common_subsequence():
    r = random.Random(2)
    assert webpages.common([1, 2], [2, 1, 2]).tolist() == [True, True]
    for _ in range(400):
        a, b = ([r.randrange(r.choice((2, 5, 30))) for _ in range(r.randrange(40))] for _ in range(2))
        kept = [x for x, s in zip(a, webpages.common(a, b).tolist()) if s]
        assert len(kept) == length(a, b)
        rest = iter(b)
        assert all(x in rest for x in kept)
    assert webpages.common([7] * 5000, [7] * 4000 + [8] * 3000).sum() == 4000


def test_copies_of_a_page_without_article_keep_their_text(spark):
    page = "<body><p>Site</p><p>Body {0}</p><p>Imprint</p></body>"
    rows = [(k, f"http://h.example/a/{k}", page.format("same")) for k in range(6)]
    rows += [(10, "http://h.example/a/9", page.format("other")), (11, "http://h.example/a/9", page.format("other"))]
    rows += [(20 + k, "http://copies.example/x", page.format("only")) for k in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in webpages.main_text(df.repartition(3)).collect()}
    assert [got[k] for k in range(6)] == ["Body same"] * 6
    assert got[10] == got[11] == "Body other"
    assert got[20] == got[21] == "Site\nBody only\nImprint"
