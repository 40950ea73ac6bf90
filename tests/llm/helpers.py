"""Small tables with all that documents may hold: NULLs, empty and long texts, ties,
repeated rows, and columns named as the operators name their own."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups".split()
CLASHING = ("row", "fp", "key", "w", "n_words", "base", "spans", "score", "token", "v", "start", "hash", "lines", "doc", "t", "_text")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(("", "", "", "s", "ing", ",")) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    long = prose(1, 400)
    rows = [(1, long), (2, long), (3, long.replace("alpha", "omega", 1)), (4, None), (5, ""), (6, "  \n\t"),
            (7, "one two"), (8, prose(2, 60)), (9, "Ünïcödé 😀 text with odd blanks"), (None, prose(3, 30)),
            (8, prose(2, 60)), (10, prose(4, 5000)), (11, "x" * 5000), (12, "a\n" * 50)]
    return rows


def frame(spark, rows, schema="doc_id long, text string"):
    """With clashing columns behind."""
    names = [f.split()[0] for f in schema.split(", ")]
    df = spark.createDataFrame(rows, schema)
    for c in CLASHING:
        if c not in names:
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("clash"))
    return df


def pairs_to_components(nodes, linked) -> dict:
    """Smallest node reachable, by union-find."""
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}
