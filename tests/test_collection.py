"""Collections on storage: life cycle, mutations, search, concurrency, streaming."""

import pytest
from pyspark.sql import functions as F

from kinfold import Record, Where, Workspace
from kinfold.errors import CollectionExists, CollectionNotFound, ConcurrentWrite, ValidationError
from kinfold.functions.embedding import BatchEmbedder, Constant, HashedWords
from kinfold.streaming.ingest import upsert_stream

WORDS = HashedWords(16)


def test_life_cycle(workspace):
    with pytest.raises(CollectionNotFound):
        workspace.get_collection("c")
    made = workspace.create_collection("c", WORDS, {"description": "test"}, space="cosine")
    assert made.count() == 0 and made.metadata == {"description": "test"}
    assert made.version.embedder == {"type": "hashed_words", "dimension": 16}
    with pytest.raises(CollectionExists):
        workspace.create_collection("c")
    made.add(Record("a", None, "some text", {"k": 1}))
    for again in (
        workspace.create_or_get_collection("c", WORDS),
        workspace.get_or_create_collection("c", WORDS),
        workspace.create_collection("c", WORDS, get_or_create=True),
        Workspace(workspace.spark, workspace.root).get_collection("c", WORDS),
    ):
        assert again.count() == 1 and again.version.space == "cosine"
    assert workspace.get_or_create_collection("d").count() == 0
    for bad in ("", "../x", "a/b"):
        with pytest.raises(ValidationError):
            workspace.create_collection(bad)
    with pytest.raises(ValidationError):
        workspace.create_collection("e", space="l7")


class Model:
    """What a collection should hold, kept as a plain dictionary."""

    def __init__(self):
        self.rows = {}

    def put(self, records, known, unknown):
        """`known` and `unknown`: whether records with a known or a new id are taken."""
        for r in records:
            text, values = self.rows.get(r.id, (None, {}))
            if known if r.id in self.rows else unknown:
                merged = {**values, **(r.metadata or {})}
                self.rows[r.id] = (r.text or text, {k: v for k, v in merged.items() if v is not None})

    def ids(self, test):
        return sorted(i for i, (text, values) in self.rows.items() if test(text, values))


@pytest.mark.parametrize("promote", [{}, {"bay": "string", "checked": "boolean"}])
def test_changes_follow_the_model(workspace, ids, promote):
    """Batches of adds, updates, upserts and deletes against a dictionary."""
    c, model = workspace.create_collection("stock", HashedWords(10), promote=promote), Model()

    def crate(n, word, **values):
        return Record(f"crate-{n}", None, f"{word} {n} {'heavy' if n % 4 == 0 else 'light'}", {"bay": "NESW"[n % 4], **values})

    steps = [
        (c.add, [crate(n, "plums", weight=n) for n in range(12)], False, True),
        (c.add, [crate(n, "pears", weight=0) for n in range(10, 15)], False, True),
        (c.update, [crate(n, "grapes", checked=True, weight=None) for n in range(0, 20, 3)], True, False),
        (c.upsert, [Record(f"crate-{n}", None, f"quinces {n}", {"checked": n % 2 == 0}) for n in range(13, 17)], True, True),
    ]
    for change, batch, known, unknown in steps:
        change(batch)
        model.put(batch, known, unknown)
        assert sorted(ids(c.get())) == sorted(model.rows)
    gone = [f"crate-{n}" for n in (1, 6, 14, 99)]
    c.delete(gone)
    c.delete(where={"bay": "S"}, where_document={"$contains": "plums"})
    for i in [*gone, *model.ids(lambda text, values: values.get("bay") == "S" and "plums" in text)]:
        model.rows.pop(i, None)
    assert {r["id"]: r["document"] for r in c.get().collect()} == {i: text for i, (text, _) in model.rows.items()}
    for i in ("crate-0", "crate-9", "crate-13", "crate-15"):
        assert dict(c.get_by_id(i).metadata) == model.rows[i][1]
    assert c.count() == len(model.rows) and c.get_by_id("crate-1") is None
    assert sorted(ids(c.where_equals("checked", True))) == model.ids(lambda _, values: values.get("checked") is True)
    few = c.search("grapes", limit=50, filter=Where().equals("bay", "N"))
    assert sorted(ids(few)) == model.ids(lambda _, values: values.get("bay") == "N")
    order = [r["id"] for r in c.df.orderBy("_batch", "_pos").collect()]
    assert order == list(model.rows)


def test_pages_of_a_batch(workspace, ids):
    c = workspace.create_collection("batch", WORDS)
    c.add([Record(f"obs{i}", None, f"{i} geese flew over the salt marsh", {"geese": i, "site": "marsh"}) for i in range(90)])
    assert c.count() == 90
    assert ids(c.get(limit=12)) == [f"obs{i}" for i in range(12)]
    first, second = ids(c.get(limit=3)), ids(c.get(limit=3, offset=3))
    assert len(set(first + second)) == 6
    assert len(ids(c.where(Where().greater_than("geese", 82)))) == 7


def test_distances_do_not_decrease(workspace):
    c = workspace.create_collection("near")
    c.add([Record.of_embedding(f"doc-{i}", [float((i * j) % 7) for j in range(8)], {"i": i}) for i in range(20)])
    rows = c.query([1.0] * 8, n_results=5).collect()
    assert len(rows) == 5 and [r["distance"] for r in rows] == sorted(r["distance"] for r in rows)
    assert c.query([1.0] * 8, n_results=2000).count() == 20
    assert c.query([1.0] * 8, include_documents=False, include_metadatas=False, include_distances=False).columns == ["id"]


def test_text_queries_under_filters(workspace, ids):
    c = workspace.create_collection("parts", HashedWords(64))
    names = ["bolt", "nut", "washer", "rivet", "hinge", "latch"]
    held = {f"p{n}": (f"{names[n % 6]} of {'steel' if n % 2 else 'brass'} size {n}", n) for n in range(18)}
    c.add([Record(i, None, text, {"n": n}) for i, (text, n) in held.items()])
    for word in ("steel", "hinge", "size 1"):
        inside = [i for i, (text, _) in held.items() if word in text]
        assert sorted(ids(c.query(text=word, n_results=50, where_document={"$contains": word}))) == sorted(inside)
        low = [i for i in inside if held[i][1] < 9]
        assert sorted(ids(c.query(text=word, n_results=50, where_document={"$contains": word}, where={"n": {"$lt": 9}}))) == sorted(low)
    # Every text is its own nearest neighbour, asked alone or all at once.
    assert ids(c.query(text=held["p7"][0], n_results=1)) == ["p7"]
    texts = c.spark.createDataFrame([(n, text) for text, n in held.values()], "qid int, text string")
    hits = c.query_many(texts=texts, n_results=1).collect()
    assert {r["qid"]: r["id"] for r in hits} == {n: i for i, (_, n) in held.items()}
    plain = workspace.get_collection("parts")
    for call in (lambda: plain.search("x"), lambda: plain.query_many(texts=texts), lambda: plain.query(), lambda: plain.query([1.0], text="x")):
        with pytest.raises(ValidationError):
            call()


def test_errors_and_no_ops(workspace):
    c = workspace.create_collection("strict")
    c.add(Record.of_embedding("a", [1.0, 2.0, 3.0]))
    before = c.version
    for call in (
        lambda: c.add(Record.of_embedding("b", [1.0, 2.0, 3.0, 4.0])),
        lambda: c.add(Record.of_embedding("b", [])),
        lambda: c.add(Record.of_text("b", "needs an embedding function")),
        lambda: c.upsert(Record.of_text("a", "needs an embedding function")),
        lambda: c.query([1.0, 2.0]),
        lambda: c.delete(),
    ):
        with pytest.raises(ValidationError):
            call()
    c.add([])
    c.update([])
    c.upsert([])
    c.update(Record("nope", None, "x"))
    c.delete("nope")
    c.delete(ids=[])
    assert c.version == before
    c.add(Record.of_embedding("a", [9.0, 9.0, 9.0]))
    assert c.get_by_id("a", include_embedding=True).embedding == [1.0, 2.0, 3.0]


def test_changes_rewrite_only_touched_files(workspace):
    c = workspace.create_collection("files")
    for name in "abc":
        c.add([Record.of_embedding(f"{name}{i}", [float(i), 1.0], {"part": name}) for i in range(3)])
    before = set(c.version.files)
    c.update(Record("b1", None, "changed"))
    assert len(before - set(c.version.files)) == 1
    c.delete(where={"part": "c"})
    assert len(before & set(c.version.files)) == 1
    assert c.count() == 6 and c.get_by_id("b1").text == "changed"


def test_writers_do_not_overwrite_each_other(workspace):
    c = workspace.create_collection("race")
    stale = c.version
    c.add(Record.of_embedding("a", [1.0]))
    with pytest.raises(ConcurrentWrite):
        c._store.commit(stale)
    assert c.count() == 1


def test_unfinished_version_is_ignored(workspace):
    c = workspace.create_collection("torn")
    c.add(Record.of_embedding("a", [1.0]))
    assert c._store.folder.create("versions/000000000003.json", '{"number": 3, "files"')
    assert c.count() == 1
    c.add(Record.of_embedding("b", [1.0]))
    assert c.count() == 2 and c.version.number == 4


def test_embedding_functions(workspace):
    c = workspace.create_collection("made", BatchEmbedder(lambda texts: [[len(t), 1.0] for t in texts]))
    c.add([Record("a", None, "abc"), Record("b", [7.0, 7.0], "abcd")])
    got = {r["id"]: r["embedding"] for r in c.get(include_embeddings=True).collect()}
    assert got == {"a": [3.0, 1.0], "b": [7.0, 7.0]}
    c.update(Record("a", None, "abcdef"))
    assert c.get_by_id("a", True).embedding == [6.0, 1.0]
    fixed = workspace.create_collection("fixed", Constant([0.1, 0.2, 0.3, 0.4]))
    fixed.add([Record("a", None, "x"), Record("b", None, "y")])
    assert [round(r["distance"], 6) for r in fixed.search("z").collect()] == [0.0, 0.0]


def test_bulk_frame(workspace, spark):
    c = workspace.create_collection("bulk", promote={"n": "bigint"})
    rows = spark.range(1000).select(
        F.col("id").cast("string").alias("id"),
        F.array(F.col("id").cast("float"), F.lit(1.0)).alias("embedding"),
        F.col("id").alias("n"),
        F.col("id").alias("_pos"),
    )
    c.add(rows)
    assert c.count() == 1000
    assert [r["id"] for r in c.query([500.0, 1.0], n_results=3).collect()] == ["500", "499", "501"]
    assert c.get(where={"n": {"$gte": 990}}).count() == 10
    c.upsert(rows.filter("n >= 995").withColumn("id", F.concat(F.lit("x"), "id")))
    assert c.count() == 1005
    assert c.get(offset=998).count() == 7


def test_stream(workspace, spark, tmp_path):
    c = workspace.create_collection("stream", promote={"n": "int"})
    source = f"file://{tmp_path}/in"
    schema = "id string, embedding array<float>, n int, _pos bigint"
    first = [("a", [1.0], 1, 1), ("a", [1.0], 2, 2), ("b", [1.0], 1, 1)]
    spark.createDataFrame(first, schema).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    writer = upsert_stream(stream, c, f"file://{tmp_path}/check")
    for more in (None, [("b", [2.0], 5, 9), ("c", [1.0], 1, 1)]):
        if more:
            spark.createDataFrame(more, schema).write.mode("append").parquet(source)
        writer.trigger(availableNow=True).start().awaitTermination()
    assert {r["id"]: r["n"] for r in c.df.collect()} == {"a": 2, "b": 5, "c": 1}
