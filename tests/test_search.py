"""Nearest-neighbour search against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.errors import ValidationError
from kinfold.functions.distance import distance, l2_normalise, vector_literal
from kinfold.functions.embedding import BatchEmbedder, Constant, HashedWords, SeededRandom, fill_embedding
from kinfold.functions.text import tokens
from kinfold.operators import approximate, results, search
from kinfold.plans.sizing import BROADCAST_SETTING


def corpus(spark, vectors, batch=0, parts=3):
    rows = [(f"v{i}", [float(x) for x in v], f"text {i}", batch, i, i % 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(
        rows, "id string, embedding array<float>, document string, _batch bigint, _pos bigint, label int"
    ).repartition(parts)


def brute(vectors, q, k, space="l2", allowed=None):
    x, q = np.asarray(vectors, np.float32).astype(float), np.asarray(q, np.float32).astype(float)
    if space == "l2":
        d = ((x - q) ** 2).sum(1)
    elif space == "ip":
        d = 1 - (x * q).sum(1)
    else:
        n = np.sqrt((x**2).sum(1) * (q**2).sum())
        d = np.array([1.0 if m == 0 else 1 - (v * q).sum() / m for v, m in zip(x, n)])
    order = [i for i in np.lexsort((np.arange(len(d)), d)) if allowed is None or allowed(i)][:k]
    return [(f"v{i}", round(float(d[i]), 9)) for i in order]


def found(df):
    return [(r["id"], round(r["distance"], 9)) for r in df.collect()]


def vectors(n, dim, seed=1):
    return np.random.default_rng(seed).normal(size=(n, dim))


def test_orthogonal_vectors(spark):
    df = corpus(spark, [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0]])
    got = found(search.knn(df, [0.9, 0.1, 0.1, 0], k=3))
    assert [i for i, _ in got] == ["v0", "v1", "v2"]
    assert [round(d, 5) for _, d in got] == [0.03, 1.63, 1.63]


@pytest.mark.parametrize("space", ["l2", "cosine", "ip"])
@pytest.mark.parametrize("n, dim, k", [(20, 8, 5), (200, 16, 7), (5, 3, 10), (300, 1, 4)])
def test_one_query(spark, space, n, dim, k):
    v = vectors(n, dim)
    v[2] = 0
    df, q = corpus(spark, v), vectors(1, dim, 9)[0]
    got = found(search.knn(df, q, k=k, space=space))
    assert got == brute(v, q, k, space)
    assert [d for _, d in got] == sorted(d for _, d in got)
    assert found(search.knn(df, q, k=3, space=space, where={"label": 1})) == brute(v, q, 3, space, lambda i: i % 3 == 1)
    assert found(search.knn_lookup(df, q, k=k, space=space)) == got


@pytest.mark.parametrize("space", ["l2", "cosine", "ip"])
def test_many_queries(spark, space):
    v, q = vectors(150, 12), vectors(23, 12, 5)
    queries = spark.createDataFrame([(f"q{i}", [float(x) for x in w]) for i, w in enumerate(q)], "qid string, embedding array<float>")
    rows = search.knn_join(corpus(spark, v), queries, k=4, space=space).orderBy("qid", "rank").collect()
    for i, w in enumerate(q):
        mine = [(r["id"], round(r["distance"], 9)) for r in rows if r["qid"] == f"q{i}"]
        assert mine == brute(v, w, 4, space)
        assert [r["rank"] for r in rows if r["qid"] == f"q{i}"] == [1, 2, 3, 4]


def test_copies_tie_in_insertion_order(spark):
    """A third and more of all rows are copies of one vector; ties come in insertion order."""
    base = vectors(40, 6)
    v = np.concatenate([base, np.repeat(base[:1], 400, axis=0), base])
    order = np.random.default_rng(3).permutation(len(v))
    v = v[order]
    for q in (base[0], vectors(1, 6, 8)[0]):
        assert found(search.knn(corpus(spark, v, parts=2), q, k=12)) == brute(v, q, 12)
    queries = spark.createDataFrame([(i, [float(x) for x in base[i]]) for i in range(10)], "qid int, embedding array<float>")
    rows = search.knn_join(corpus(spark, v, parts=2), queries, k=5).collect()
    for i in range(10):
        mine = sorted((r["rank"], r["id"], round(r["distance"], 9)) for r in rows if r["qid"] == i)
        assert [(b, c) for _, b, c in mine] == brute(v, base[i], 5)


def test_copies_without_the_shortcut_agree(spark, monkeypatch):
    v = np.repeat(vectors(4, 5), 60, axis=0)
    monkeypatch.setattr(search, "RECOMPUTE_CELLS", 50)
    monkeypatch.setattr(search, "MATRIX_CELLS", 500)
    block = search.QueryBlock(search.pa.array(range(4)), vectors(4, 5), "l2", 3)
    best = search._Best(4, 3)
    ids = search.pa.array([f"v{i}" for i in range(len(v))])
    n = np.arange(len(v))
    search._compare(best, block, np.arange(4), v, n * 0, n, ids)
    for i in range(4):
        mine = sorted(best.pos[i].tolist())
        d = ((v - block.vectors[i]) ** 2).sum(1)
        assert mine == sorted(np.lexsort((n, d))[:3].tolist())


@pytest.mark.parametrize("space", ["l2", "cosine", "ip"])
def test_many_pairs_are_dealt_to_many_tasks(spark, monkeypatch, space):
    """One split of the corpus and all its rows as queries: the pairs still go to many tasks, with copies in each."""
    v = np.concatenate([vectors(60, 8), np.repeat(vectors(3, 8, 4), 25, axis=0)])
    queries = spark.createDataFrame([(i, [float(x) for x in w]) for i, w in enumerate(v)], "qid int, embedding array<float>")
    df = corpus(spark, v, parts=1)
    whole = search.knn_join(df, queries, k=3, space=space).select("qid", "rank", "id", "distance").collect()
    monkeypatch.setattr(search, "TASK_PAIRS", 1500, raising=False)
    monkeypatch.setattr(search, "SHARD_CELLS", 40 * 8, raising=False)
    dealt, _ = search.hits_of_queries(df, queries, 3, space, "qid", "embedding")
    cut = search.knn_join(df, queries, k=3, space=space).select("qid", "rank", "id", "distance").collect()
    assert sorted(whole) == sorted(cut) and len(cut) == 3 * len(v)
    assert "shard" in dealt._jdf.queryExecution().toString()


@pytest.mark.parametrize("shift", [0.0, 300.0])
def test_single_precision_loses_nothing(spark, shift):
    """Many rows are first told apart in single precision; rows that it cannot tell apart are measured exactly."""
    v = (vectors(9000, 6) + shift).astype(np.float32).astype(float)
    v[4000:4040] = v[7]
    q = np.concatenate([v[5:9], (vectors(3, 6, 8) + shift).astype(np.float32)])
    queries = spark.createDataFrame([(i, [float(x) for x in w]) for i, w in enumerate(q)], "qid int, embedding array<float>")
    rows = search.knn_join(corpus(spark, v, parts=1), queries, k=5).collect()
    for i, w in enumerate(q):
        mine = sorted((r["rank"], r["id"], round(r["distance"], 9)) for r in rows if r["qid"] == i)
        assert [(b, c) for _, b, c in mine] == brute(v, w.astype(float), 5)


def test_large_query_side_is_cut_into_blocks(spark):
    v, q = vectors(60, 8), vectors(40, 8, 5)
    queries = spark.createDataFrame([(i, [float(x) for x in w]) for i, w in enumerate(q)], "qid int, embedding array<float>")
    whole = search.knn_join(corpus(spark, v), queries, k=3).select("qid", "rank", "id").collect()
    spark.conf.set(BROADCAST_SETTING, "2000")
    try:
        cut = search.knn_join(corpus(spark, v), queries, k=3).select("qid", "rank", "id").collect()
    finally:
        spark.conf.unset(BROADCAST_SETTING)
    assert sorted(whole) == sorted(cut) and len(cut) == 120


def test_undefined_distances_rank_last(spark):
    v = vectors(6, 4)
    v[1, 2] = np.nan
    got = [r["id"] for r in search.knn(corpus(spark, v), vectors(1, 4, 2)[0], k=10).collect()]
    assert len(got) == 6 and got[-1] == "v1"


def test_records_without_vectors_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 0.0], 0, 0), ("b", None, 0, 1)], "id string, embedding array<float>, _batch bigint, _pos bigint"
    )
    assert [r["id"] for r in search.knn(df, [1.0, 0.0]).collect()] == ["a"]


def test_more_results_than_matches(spark):
    df = corpus(spark, vectors(5, 3))
    assert search.knn(df, [0, 0, 1], k=10).count() == 5
    assert search.knn(df.filter(F.lit(False)), [0, 0, 1], k=10).count() == 0
    empty = spark.createDataFrame([], "qid int, embedding array<float>")
    assert search.knn_join(df, empty).count() == 0


def test_include_flags(spark):
    df = corpus(spark, vectors(4, 3))
    q = [0, 0, 1]
    assert search.knn(df, q).columns == ["id", "document", "label", "distance"]
    plain = search.knn(df, q, include_metadatas=False, include_documents=False, include_distances=False)
    assert plain.columns == ["id"]
    assert "embedding" in search.knn(df, q, include_embeddings=True).columns


def test_bad_arguments(spark):
    df = corpus(spark, vectors(4, 3))
    for call in (
        lambda: search.knn(df, [], k=1),
        lambda: search.knn(df, [1, 2, 3], k=0),
        lambda: search.knn(df, [1, 2, 3], space="l7"),
        lambda: search.knn(df, [1, 2], dim=search.dimension(df)),
        lambda: search.knn_text(df, "x", None),
    ):
        with pytest.raises(ValidationError):
            call()
    twice = spark.createDataFrame([(1, [1.0, 2.0, 3.0])] * 2, "qid int, embedding array<float>")
    ragged = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "qid int, embedding array<float>")
    for queries in (twice, ragged):
        with pytest.raises(ValidationError):
            search.knn_join(df, queries)


def test_distance_columns(spark):
    v, q = vectors(10, 5), vectors(1, 5, 4)[0].astype(np.float32)
    v[3] = 0
    df = corpus(spark, v)
    for space in ("l2", "cosine", "ip"):
        rows = df.select("id", distance(F.col("embedding"), vector_literal(q), space).alias("distance")).collect()
        got = sorted((round(r["distance"], 9), r["id"]) for r in rows)
        assert got == sorted((d, i) for i, d in brute(v, q, 10, space))


def test_search_ships_only_vectors_to_python(spark, tmp_path):
    path = f"file://{tmp_path}/c"
    corpus(spark, vectors(50, 4)).write.parquet(path)
    plan = search.knn(spark.read.parquet(path), [0, 0, 0, 1], where={"label": 1})._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    with_vectors = [s for s in scans if "embedding" in s]
    assert len(scans) == 2 and len(with_vectors) == 1
    assert "document" not in with_vectors[0] and "EqualTo(label,1)" in with_vectors[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


# ------------------------------------------------------------------- approximate


def test_cells(spark, tmp_path):
    centres = vectors(8, 10, 2) * 5
    v = np.concatenate([c + vectors(30, 10, i) * 0.3 for i, c in enumerate(centres)] + [np.repeat(centres[:1], 120, axis=0)])
    df = corpus(spark, v)
    cells = approximate.train_cells(df, 8, iterations=5)
    path = f"file://{tmp_path}/cells"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4000")
    try:
        approximate.write_cells(df, cells, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored, again = approximate.read_cells(spark, path)
    assert stored.count() == len(v) and np.allclose(again.centroids, cells.centroids)
    queries = spark.createDataFrame([(i, [float(x) for x in v[i * 29]]) for i in range(8)], "qid int, embedding array<float>")
    exact = search.knn_join(df, queries, k=5)
    every = approximate.approximate_knn_join(stored, again, queries, k=5, probes=8)
    key = lambda d: sorted((r["qid"], r["rank"], r["id"]) for r in d.collect())
    assert key(every) == key(exact)
    few = approximate.approximate_knn_join(stored, again, queries, k=5, probes=2)
    assert approximate.recall(few, exact).first()["recall"] >= 0.9
    pruned = approximate.pruned_knn_join(stored, again, queries, k=5, probes=1)
    assert key(pruned) == key(exact)
    reach = again.reachable(v[::29][:8].astype(np.float32).astype(float), np.full(8, 1.0))
    assert reach.any(axis=1).all() and reach.mean() < 0.7
    assert key(approximate.pruned_knn_join(stored, again, queries, k=200, probes=1)) == key(search.knn_join(df, queries, k=200))
    rough = approximate.train_cells(df, 8, iterations=2, training_fraction=0.5)
    sampled = approximate.assign_cells(df, rough)
    assert sampled.count() == len(v)
    found_all = approximate.approximate_knn_join(sampled, rough, queries, k=5, probes=rough.count)
    assert key(found_all) == key(exact)
    one = approximate.approximate_knn(stored, again, v[3], k=5, probes=8)
    assert found(one) == brute(v, v[3], 5)
    plan = approximate.approximate_knn(stored, again, v[3], k=5, probes=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_cell" in plan or "_cell" in plan[plan.index("PartitionFilters") :]
    hot = stored.groupBy("_cell").count().orderBy(F.desc("count")).first()["_cell"]
    files = stored.filter(F.col("_cell") == hot).select(F.col("_metadata.file_path")).distinct().count()
    assert files > 1


# ------------------------------------------------------------------- result shapes


def test_arrays_and_rows(spark):
    rows = spark.createDataFrame(
        [(1, 2, "b", None), (1, 1, "a", "x"), (2, 1, "c", "y")], "qid int, rank int, id string, document string"
    )
    packed = results.to_arrays(rows, {"id": "ids", "document": "documents"}, by=["qid"])
    assert {r["qid"]: (r["ids"], r["documents"]) for r in packed.collect()} == {1: (["a", "b"], ["x", None]), 2: (["c"], ["y"])}
    back = results.to_rows(packed, {"ids": "id", "documents": "document"}, by=["qid"]).collect()
    assert sorted((r["qid"], r["rank"], r["id"]) for r in back) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]


def test_short_arrays_are_padded(spark):
    df = spark.createDataFrame(
        [(["a", "b", "c"], ["x"], None), ([], ["extra"], ["m"])], "ids array<string>, documents array<string>, notes array<string>"
    )
    got = results.to_rows(df, {"ids": "id", "documents": "document", "notes": "note"}).collect()
    assert [(r["id"], r["document"], r["note"]) for r in got] == [("a", "x", None), ("b", None, None), ("c", None, None)]


# ------------------------------------------------------------------- embedding functions


def test_tokens(spark):
    df = spark.createDataFrame([("Hello, World! it's  fine",)], "t string")
    assert df.select(tokens(F.col("t"))).first()[0] == ["hello", "world", "it", "s", "fine"]


def test_hashed_words(spark):
    words = HashedWords(10)
    df = spark.createDataFrame([("a b a",), ("A, b. A!",), ("",), (" \n ",), (None,), ("...",)], "t string")
    got = [r[0] for r in df.select(words.embed(F.col("t"))).collect()]
    assert got[0] == got[1] and abs(sum(x * x for x in got[0]) - 1) < 1e-6
    assert all(g == [0.0] * 10 for g in got[2:])


def test_batch_function(spark):
    def shape(texts, factor):
        return [[len(t) * factor, 1.0] for t in texts]

    embedder = BatchEmbedder(shape, {"type": "shape"}, setup=lambda: 2)
    df = spark.createDataFrame([("abc", None), ("", None), (None, None), ("x", [9.0, 9.0])], "t string, e array<float>")
    got = [r[0] for r in df.select(fill_embedding(F.col("e"), F.col("t"), embedder)).collect()]
    assert got == [[6.0, 1.0], None, None, [9.0, 9.0]]


def test_constant_and_random(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "t string")
    assert df.select(Constant([0.5, 0.25]).embed(F.col("t"))).first()[0] == [0.5, 0.25]
    a, b, c = [r[0] for r in df.select(SeededRandom(4).embed(F.col("t"))).collect()]
    assert a == c and a != b and all(0 <= x < 1 for x in a + b)


def test_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(l2_normalise(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
