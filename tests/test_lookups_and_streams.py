"""Id lookups by file, exactly-once streams, search that widens over cells, facets, one embedding per text."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold import Record, Where
from kinfold.errors import ValidationError
from kinfold.functions.embedding import BatchEmbedder, embed_distinct
from kinfold.functions.values import pack_all
from kinfold.operators import approximate, search
from kinfold.operators.facets import facets
from kinfold.schema import RECORD
from kinfold.streaming.ingest import upsert_stream

# --------------------------------------------------------------------------- lookups by id


def test_lookups_read_only_files_in_range(workspace, ids):
    c = workspace.create_collection("ranged")
    for letter in "abcd":
        c.add([Record.of_embedding(f"{letter}{n}", [float(n)], {"n": n}) for n in range(5)])
    assert len(c.version.files) == len(c.version.ranges) == 4
    assert len(c.get(ids=["b1", "b3"]).inputFiles()) == 1 and sorted(ids(c.get(ids=["b1", "b3"]))) == ["b1", "b3"]
    assert len(c.get(ids=["a0", "d4"]).inputFiles()) == 2
    assert ids(c.get(ids=["zzz"])) == [] and c.get_by_id("bb") is None and c.get_by_id("c2").metadata == {"n": 2}
    c.update(Record.of_embedding("b1", [9.0]))
    c.delete(["c0", "c4", "nope"])
    assert sorted(ids(c.get(ids=["b1", "c0", "c1", "c4"]))) == ["b1", "c1"]
    assert len(c.version.ranges) == len(c.version.files)
    c.add([Record.of_embedding(i, [1.0]) for i in ("é", "日", "\U0001f600", "~")])
    assert sorted(ids(c.get(ids=["日", "~", "\U0001f600"]))) == sorted(["日", "~", "\U0001f600"])
    c.delete(["é", "日", "\U0001f600", "~"])
    assert ids(c.get(ids=["é"])) == []


def test_versions_without_ranges_are_read_whole(workspace, ids):
    from dataclasses import replace

    c = workspace.create_collection("old")
    c.add(Record.of_embedding("a", [1.0]))
    c._store.commit(replace(c.version, ranges={}))
    assert ids(c.get(ids=["a"])) == ["a"]


# --------------------------------------------------------------------------- streams

EVENT = "id string, embedding array<float>, n int, _pos bigint, at timestamp"


def test_replayed_batch_is_skipped(workspace):
    c = workspace.create_collection("once", promote={"n": "int"})
    assert c.upsert(Record.of_embedding("a", [1.0], {"n": 1}), stream=("s", 0)) is True
    number = c.version.number
    assert c.upsert(Record.of_embedding("a", [1.0], {"n": 99}), stream=("s", 0)) is False
    assert c.version.number == number and c.get_by_id("a").metadata["n"] == 1
    c.upsert(Record.of_embedding("a", [1.0], {"n": 2}))  # another writer in between
    assert c.upsert(Record.of_embedding("a", [1.0], {"n": 99}), stream=("s", 0)) is False
    assert c.upsert(Record.of_embedding("a", [1.0], {"n": 3}), stream=("t", 0)) is True
    assert c.upsert(Record.of_embedding("b", [1.0], {"n": 4}), stream=("s", 1)) is True
    assert c.version.streams == {"s": 1, "t": 0} and {r["id"]: r["n"] for r in c.df.collect()} == {"a": 3, "b": 4}
    c.delete("a")
    assert c.version.streams == {"s": 1, "t": 0}


def test_stream_survives_a_lost_commit(workspace, spark, tmp_path):
    """The rows of a batch are published, then the stream dies: its restart sends the batch again."""
    from pyspark.sql.streaming import StreamingQueryException

    c = workspace.create_collection("died", promote={"n": "int"})
    source = f"file://{tmp_path}/in"
    rows = [("a", [1.0], 1, 1, None), ("b", [1.0], 2, 1, None)]
    spark.createDataFrame(rows, EVENT).drop("at").write.parquet(source)
    stream = spark.readStream.schema("id string, embedding array<float>, n int, _pos bigint").parquet(source)
    real, calls = c.upsert, []

    def dying(batch, stream):
        calls.append(real(batch, stream))
        if len(calls) == 1:
            raise RuntimeError("lost after publishing")

    c.upsert = dying
    writer = upsert_stream(stream, c, f"file://{tmp_path}/check").trigger(availableNow=True)
    with pytest.raises(StreamingQueryException):
        writer.start().awaitTermination()
    number = c.version.number
    writer.start().awaitTermination()
    assert calls == [True, False] and c.version.number == number
    assert {r["id"]: r["n"] for r in c.df.collect()} == {"a": 1, "b": 2}


def test_late_copies_are_dropped(workspace, spark, tmp_path):
    c = workspace.create_collection("late", promote={"n": "int"})
    source = f"file://{tmp_path}/in"
    parts = [[("a", 1, 1, "10:00")], [("a", 2, 2, "10:05"), ("a", 1, 1, "10:00")], [("a", 1, 1, "10:00"), ("b", 5, 1, "10:06")]]
    for part in parts:
        rows = [(i, [1.0], n, pos, f"2024-01-01 {at}:00") for i, n, pos, at in part]
        df = spark.createDataFrame(rows, "id string, embedding array<float>, n int, _pos bigint, at string")
        df.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENT).parquet(source)
        writer = upsert_stream(stream, c, f"file://{tmp_path}/check", event_time="at", delay="1 hour")
        writer.trigger(availableNow=True).start().awaitTermination()
    # The last batch's copy of a's first record would have undone the second.
    assert {r["id"]: r["n"] for r in c.df.collect()} == {"a": 2, "b": 5}


# --------------------------------------------------------------------------- search under filters


def test_widening_search_is_exact_and_reads_few_cells(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(24, 6)) * 5
    x = (centers[draw.integers(0, 24, 3000)] + draw.normal(size=(3000, 6)) * 0.2).astype(np.float32)
    x[500:900] = x[7]
    rows = [(f"v{n}", [float(c) for c in v], "even" if n % 2 else "odd", 0, n, n % 50) for n, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id string, embedding array<float>, document string, _batch bigint, _pos bigint, tag int")
    path = f"file://{tmp_path}/cells"
    approximate.write_cells(df, approximate.train_cells(df, 24, iterations=6), path)
    records, cells = approximate.read_cells(spark, path)
    read = []
    plain = approximate.nearest_of

    def counting(rows, vector, k):
        read.append(len({f.split("_cell=")[1].split("/")[0] for f in rows.inputFiles() if "_cell=" in f} & visited(rows)))
        return plain(rows, vector, k)

    def visited(rows):
        return {str(r[0]) for r in rows.select("_cell").distinct().collect()}

    monkeypatch.setattr(approximate, "nearest_of", counting)
    for where, text, k in (({"tag": 3}, None, 5), (None, {"$contains": "odd"}, 20), ({"tag": {"$lt": 2}}, {"$contains": "even"}, 3), ({"tag": -1}, None, 4), (None, None, 900)):
        for q in (x[0], x[7], centers.mean(axis=0)):
            got = approximate.widening_knn(records, cells, q, k, where, text).select("id", F.round("distance", 6)).collect()
            want = search.knn(df, q, k, where, text).select("id", F.round("distance", 6)).collect()
            assert got == want
    read.clear()
    approximate.widening_knn(records, cells, x[0], 2, {"tag": {"$lt": 25}}).collect()
    assert sum(read) < 12
    with pytest.raises(ValidationError):
        approximate.widening_knn(records, approximate.Cells(cells.centroids), x[0])


# --------------------------------------------------------------------------- facets


def test_facets_equal_plain_counts(spark, workspace):
    values = [{"s": ["x", "y", "1"][n % 3], "i": n % 4, "mixed": [1, "1", True, 1.5, None][n % 5]} for n in range(200)] + [{}, None]
    df = spark.createDataFrame([(f"r{n}", None, None, pack_all(m or {}) if m is not None else None, 0, n) for n, m in enumerate(values)], RECORD)
    df = df.withColumn("own", F.when(F.col("_pos") % 2 == 0, F.col("_pos") % 7).cast("int"))
    counts = collections.Counter()
    for n, m in enumerate(values):
        for k, v in (m or {}).items():
            if v is not None:
                tag = "b" if isinstance(v, bool) else "s" if isinstance(v, str) else "i" if isinstance(v, int) else "d"
                counts[k, tag, str(v).lower() if tag == "b" else str(v)] += 1
        if n % 2 == 0:
            counts["own", "i", str(n % 7)] += 1
    want = set()
    for key in {k for k, _, _ in counts}:
        best = sorted(((-n, t, v) for (k, t, v), n in counts.items() if k == key))[:3]
        want |= {(key, t, v, -n, r) for r, (n, t, v) in enumerate(best, 1)}
    got = facets(df, top=3)
    assert set(map(tuple, got.collect())) == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    assert set(map(tuple, facets(df, ["own", "s"], 3).collect())) == {r for r in want if r[0] in ("own", "s")}
    with pytest.raises(ValidationError):
        facets(df, top=0)
    c = workspace.create_collection("faceted")
    c.add([Record.of_embedding(f"a{n}", [1.0], {"color": "red" if n % 3 else "blue"}) for n in range(9)])
    assert [tuple(r) for r in c.facets(["color"], where=Where().equals("color", "red")).collect()] == [("color", "s", "red", 6, 1)]


# --------------------------------------------------------------------------- one embedding per text


def test_each_text_is_embedded_once(spark, tmp_path):
    seen = f"{tmp_path}/calls"

    def shape(texts):
        with open(seen, "a") as log:
            log.writelines(f"{t!r}\n" for t in texts)
        return [[float(len(t)), 1.0] for t in texts]

    texts = ["hot"] * 600 + [f"text {n % 300}" for n in range(900)] + [None, None, ""]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string").repartition(6)
    got = {r["n"]: r["embedding"] for r in embed_distinct(df, "text", BatchEmbedder(shape)).collect()}
    assert got == {n: None if t is None else [float(len(t)), 1.0] for n, t in enumerate(texts)}
    calls = collections.Counter(open(seen).read().splitlines())
    assert set(calls.values()) == {1} and len(calls) == 302
