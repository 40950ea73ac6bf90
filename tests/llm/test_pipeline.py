"""Stages of the pipeline, against plain versions of their rules."""

import random

import pytest

import corpus_pipeline
from filigree.llm.work import numbered, only
from tests.llm.helpers import frame, pairs_to_components, prose, texts
from tests.llm.test_texts import EMPTY, slow_fingerprint


def edited(seed, base, edits):
    """``base`` with some words replaced, by words that occur nowhere else."""
    r, w = random.Random(seed), base.split()
    for k in range(edits):
        w[r.randrange(len(w))] = f"edit{seed}x{k}"
    return " ".join(w)


def test_one_row_of_a_group_stays(spark):
    """Groups as of fingerprints, whatever ids the rows have, NULL or repeated."""
    a, b, c, d = (prose(k, 100) for k in range(4))
    rows = [(1, a), (1, a), (1, d), (None, a), (None, b), (None, b), (None, edited(1, b, 1)), (None, c), (7, c), (5, c),
            (None, None), (None, ""), (20, prose(8, 900)), (19, edited(2, prose(8, 900), 1)), (18, edited(3, prose(8, 900), 2))]
    docs = frame(spark, rows).repartition(3)
    got = corpus_pipeline.near_duplicates_stage(spark, docs, "")
    assert got.columns == docs.columns
    fp = [slow_fingerprint(t) for _, t in rows]
    comp = pairs_to_components(range(len(rows)), [(x, y) for x in range(len(rows)) for y in range(x) if (fp[x] ^ fp[y]).bit_count() <= 3])
    groups = {}
    for k, root in comp.items():
        groups.setdefault(root, []).append(rows[k][0])
    first = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(str(i) for i, _ in kept) == sorted(map(str, first)) and len(groups) < 9
    assert all(x in rows for x in kept)
    assert corpus_pipeline.near_duplicates_stage(spark, spark.createDataFrame([], EMPTY), "").collect() == []


def test_only_contaminated_rows_go(spark, tmp_path):
    """Not the clean ones that share an id, or the lack of one, with them."""
    passage = prose(4000, 40)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    bad, clean = passage + " " + prose(4001, 10), [prose(10 + k, 60) for k in range(4)]
    rows = [(None, bad), (None, clean[0]), (None, clean[1]), (3, bad), (3, clean[2]), (4, clean[3]), (4, clean[3]), (5, None)]
    docs = frame(spark, rows).repartition(3)
    got = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted((x for x in rows if x[1] != bad), key=key)


@pytest.mark.parametrize("stay", [True, False])
def test_picked_rows_without_dealing_out_the_rest(spark, stay):
    """However many are picked, the texts stay where they are."""
    from pyspark.sql import functions as F

    docs = spark.range(0, 100_000, 1, 3).select("id", F.lit("t").alias("_block"), F.lit(None).cast("string").alias("_bits"))
    rows, row = numbered(docs)
    for rule in ("id % 3 = 1", "id < 40000", "id < 0", "true"):
        picked = rows.where(rule).select(F.col(row).alias("_picked"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            got = only(rows, row, picked, stay)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert got.columns == docs.columns and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
            want = docs.where(rule if stay else f"not ({rule})")
            assert got.count() == want.count() and got.select("id").exceptAll(want.select("id")).isEmpty()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stages_leave_texts_where_they_are(spark, tmp_path):
    """What stays is told by narrow rows, also where these are too many for Spark to broadcast unasked."""
    spark.createDataFrame([(1, prose(4000, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(k, prose(k, 30)) for k in range(4)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage in (corpus_pipeline.near_duplicates_stage, corpus_pipeline.decontamination_stage):
            got = stage(spark, docs, str(tmp_path))
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
            assert got.count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
