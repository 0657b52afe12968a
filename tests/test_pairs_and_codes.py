"""Pairs under a threshold, product codes, and many queries through shards, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.errors import ValidationError
from kinfold.operators import approximate, pairs, quantised, search
from kinfold.plans.sizing import BROADCAST_SETTING

SCHEMA = "id string, embedding array<float>, _batch bigint, _pos bigint"


def corpus(spark, x):
    return spark.createDataFrame([(f"v{n:05}", None if v is None else [float(c) for c in v], 0, n) for n, v in enumerate(x)], SCHEMA)


def clustered(seed, n, dim, clusters, spread):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(clusters, dim))[draw.integers(0, clusters, n)] + spread * draw.normal(size=(n, dim))).astype(np.float32)


def naive_range_join(x, radius):
    d = np.sqrt(np.square(x[:, None].astype(np.float64) - x[None].astype(np.float64)).sum(axis=2))
    near = d <= radius
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            return [(f"v{n:05}", int(near[n].sum()), f"v{label[n]:05}") for n in range(len(x))]
        label = new


@pytest.mark.parametrize("block_rows, most_pivots", [(8192, 4096), (20, 4096), (7, 1), (10_000, 30)])
@pytest.mark.parametrize("radius", [0.0, 0.3, 0.9, 50.0])
def test_range_join_equals_all_pairs(spark, monkeypatch, block_rows, most_pivots, radius):
    monkeypatch.setattr(pairs, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(pairs, "MOST_PIVOTS", most_pivots)
    x = clustered(2, 150, 5, 12, 0.1)
    x[100:140] = x[3]  # one vector in a quarter of the rows
    x[141] = -x[3] * 0
    x[142] = 0
    got = sorted(map(tuple, pairs.range_join(corpus(spark, x), radius).collect()))
    assert got == naive_range_join(x, radius)


def test_chain_is_one_class(spark):
    x = np.zeros((300, 2), np.float32)
    x[:, 0] = np.random.default_rng(1).permutation(300)
    got = sorted(map(tuple, pairs.range_join(corpus(spark, x), 1.0).collect()))
    assert {r[2] for r in got} == {"v00000"} and sorted(r[1] for r in got) == [1, 1] + [2] * 298


def test_range_join_of_awkward_rows(spark):
    df = corpus(spark, [[1, 0], None, [1, 0.5], [float("nan"), 0], [float("inf"), 0], [0.0, 0], [-0.0, 0]])
    df = df.selectExpr("*", "1 AS node", "2 AS n", "3 AS home")
    got = sorted(map(tuple, pairs.range_join(df, 0.5).collect()))
    assert got == [("v00000", 1, "v00000"), ("v00002", 1, "v00000"), ("v00005", 1, "v00005"), ("v00006", 1, "v00005")]
    assert pairs.range_join(df.limit(0), 1.0).collect() == []
    with pytest.raises(ValidationError):
        pairs.range_join(df, -1.0)
    with pytest.raises(ValidationError):
        pairs.range_join(corpus(spark, [[1.0], [1.0, 2.0]]), 1.0)


def test_links_grow_with_vectors_not_pairs(spark):
    """A dense ball of n vectors has n^2 pairs; what leaves the tasks is a row per vector and block."""
    x = np.random.default_rng(0).normal(size=(400, 3)).astype(np.float32) * 0.01
    nodes = pairs.distinct_vectors(corpus(spark, x))
    pivots = pairs.Pivots(np.zeros((1, 3)), np.array([1.0]))
    placed = pairs._homes(nodes, pivots, 3).withColumn("block", F.lit(0))
    found = pairs._links(pairs._dealt(placed, pivots, np.array([1]), 1.0, 3), 1.0, 3).collect()
    assert len(found) == 400 and all(r["links"] == 399 for r in found)


# --------------------------------------------------------------------------- product codes


def test_codes_approximate_what_they_stand_for(spark):
    x = clustered(4, 3000, 16, 20, 0.2)
    df = corpus(spark, x)
    cells = approximate.train_cells(df, 8, iterations=4)
    made = quantised.train_quantiser(df, cells, parts=8)
    home, codes, fixed = made.encode(x.astype(np.float64))
    decoded = np.concatenate([made.codewords[p][codes[:, p]] for p in range(8)], axis=1)
    q = x[:5].astype(np.float64)
    tables, gaps = made.tables(q), made.gaps(q)
    for n in range(5):
        near = gaps[n, home] - 2 * sum(tables[n, p][codes[:, p]] for p in range(8)) + fixed
        whole = cells.centroids[home] + decoded
        assert np.allclose(near, np.square(q[n] - whole).sum(axis=1))
    error = np.square(cells.centroids[home] + decoded - x).sum(axis=1).mean()
    assert error < 0.3 * np.square(cells.centroids[home] - x).sum(axis=1).mean()


@pytest.mark.parametrize("limit", [None, "400000"])
def test_tuned_search_reaches_its_recall(spark, limit):
    x = clustered(5, 3000, 16, 30, 0.4)
    df, queries = corpus(spark, x), corpus(spark, clustered(6, 300, 16, 30, 0.4)).select(F.col("id").alias("qid"), "embedding")
    cells = approximate.train_cells(df, 12, iterations=4)
    made = quantised.train_quantiser(df, cells, parts=8)
    index = quantised.encode(df, made).cache()
    assert index.count() == 3000
    effort = quantised.tune(df, made, index, queries.limit(150), k=5, target=0.9)
    if limit:
        spark.conf.set(BROADCAST_SETTING, limit)
    try:
        found = quantised.search(df, index, made, effort, queries, 5).cache()
        exact = search.knn_join(df, queries, 5)
        assert found.groupBy("qid").count().filter("count <> 5").count() == 0
        assert approximate.recall(found, exact).first()["recall"] >= 0.9
    finally:
        spark.conf.unset(BROADCAST_SETTING)
    whole = quantised.search(df, index, made, quantised.Effort(np.inf, 3000), queries.limit(20), 5)
    assert approximate.recall(whole, search.knn_join(df, queries.limit(20), 5)).first()["recall"] == 1.0


def test_many_queries_meet_the_codes_in_one_job(spark, monkeypatch):
    x = np.concatenate([clustered(5, 2500, 16, 30, 0.4), np.ones((300, 16), np.float32)])
    df = corpus(spark, x)
    queries = df.select(F.col("id").alias("qid"), "embedding")
    cells = approximate.train_cells(df, 12, iterations=4)
    made = quantised.train_quantiser(df, cells, parts=8)
    index = quantised.encode(df, made).cache()

    def nearest(factor):
        rows = quantised.search(df, index, made, quantised.Effort(factor, 40), queries, 5).collect()
        return {(r["qid"], r["rank"]): (r["id"], round(r["distance"], 9)) for r in rows}

    for factor in (1.5, np.inf):
        whole = nearest(factor)
        spark.conf.set(BROADCAST_SETTING, "60000")
        try:
            with monkeypatch.context() as m:
                # Neither queries nor codes pass through the driver, block after block.
                m.setattr(quantised, "_candidates", None)
                dealt = nearest(factor)
        finally:
            spark.conf.unset(BROADCAST_SETTING)
        # Rounding decides among rows at the depth's edge, seldom among the nearest.
        assert dealt.keys() == whole.keys()
        assert sum(dealt[k] == whole[k] for k in whole) >= 0.999 * len(whole)


def test_codes_need_fitting_parts(spark):
    df = corpus(spark, clustered(1, 50, 6, 3, 0.1))
    with pytest.raises(ValidationError):
        quantised.train_quantiser(df, approximate.train_cells(df, 2, iterations=1), parts=4)


# --------------------------------------------------------------------------- many queries


@pytest.mark.parametrize("space", ["l2", "cosine", "ip"])
def test_shards_give_the_hits_of_one_block(spark, space):
    x = clustered(8, 500, 6, 9, 0.3)
    x[200:350] = x[7]  # ties everywhere
    df = corpus(spark, [*x, None]).withColumn("_batch", F.when(F.col("_pos") % 3 > 0, F.col("_batch")))
    queries = df.filter("embedding IS NOT NULL").select(F.col("_pos").alias("qid"), "embedding")
    names = ["qid", "rank", "id", "distance"]
    whole = search.knn_join(df, queries, 7, space=space).select(*names).collect()
    spark.conf.set(BROADCAST_SETTING, "6000")
    try:
        cut = search.knn_join(df, queries, 7, space=space)
        plan = cut._jdf.queryExecution().executedPlan().toString()
        rows = cut.select(*names).collect()
    finally:
        spark.conf.unset(BROADCAST_SETTING)
    assert sorted(rows) == sorted(whole) and len(rows) == 3500
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_shards_under_cells(spark):
    x = clustered(9, 400, 6, 9, 0.3)
    df = corpus(spark, x)
    cells = approximate.train_cells(df, 6, iterations=3)
    assigned = approximate.assign_cells(df, cells).cache()
    measured = approximate.with_radii(assigned, cells)
    queries = df.select(F.col("_pos").alias("qid"), "embedding")
    names = ["qid", "rank", "id"]
    exact = sorted(search.knn_join(df, queries, 4).select(*names).collect())
    some = sorted(approximate.approximate_knn_join(assigned, cells, queries, 4, probes=2).select(*names).collect())
    spark.conf.set(BROADCAST_SETTING, "6000")
    try:
        assert sorted(approximate.pruned_knn_join(assigned, measured, queries, 4, probes=1).select(*names).collect()) == exact
        assert sorted(approximate.approximate_knn_join(assigned, cells, queries, 4, probes=2).select(*names).collect()) == some
    finally:
        spark.conf.unset(BROADCAST_SETTING)


def test_text_is_embedded_once(spark):
    from kinfold.functions.embedding import HashedWords
    from kinfold.plans.tables import Tables

    words = HashedWords(16)
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = search.knn_text(t.embedded_docs(words), "some words", words)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
