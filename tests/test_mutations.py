"""Mutations as DataFrame functions, paging, and properties that hold for any collection."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.errors import ValidationError
from kinfold.functions.values import unpack_all
from kinfold.operators import get as get_ops
from kinfold.operators import mutate
from kinfold.schema import as_collection, conform
from kinfold.sources.records import Record, records_frame


def start(spark, records, promote=""):
    extra = f", {promote}" if promote else ""
    schema = (
        "id string, embedding array<float>, document string, "
        "metadata map<string,struct<t:string,s:string,i:bigint,d:double,b:boolean>>, _batch bigint, _pos bigint" + extra
    )
    empty = spark.createDataFrame([], schema)
    return mutate.add(empty, records_frame(spark, records), batch_no=0, small=True)


def rows(df):
    shown = {}
    for r in df.collect():
        extra = {k: v for k, v in r.asDict().items() if k not in ("id", "embedding", "document", "metadata", "_batch", "_pos")}
        shown[r["id"]] = (r["embedding"], r["document"], {**unpack_all(r["metadata"]), **{k: v for k, v in extra.items() if v is not None}})
    return shown


A = Record("a", [1.0, 0.0], "text a", {"x": 1, "y": "q"})
B = Record("b", [0.0, 1.0], "text b", {"x": 2})


@pytest.mark.parametrize("promote", ["", "x bigint"])
@pytest.mark.parametrize("small", [True, False])
class TestBatches:
    def test_add_keeps_the_first(self, spark, small, promote):
        base = start(spark, [A, B], promote)
        new = records_frame(spark, [Record("a", [9.0, 9.0], "other"), Record("c", [1.0, 1.0], "", {"x": None, "z": 1})])
        got = rows(mutate.add(base, new, 1, small))
        assert got == {**rows(base), "c": ([1.0, 1.0], None, {"z": 1})}

    def test_update(self, spark, small, promote):
        base = start(spark, [A, B], promote)
        new = records_frame(spark, [Record("a", None, "new", {"x": None, "y": 2.5}), Record("zzz", None, "unknown")])
        assert rows(mutate.update(base, new, small)) == {"a": ([1.0, 0.0], "new", {"y": 2.5}), "b": rows(base)["b"]}
        blank = records_frame(spark, [Record("a", [5.0, 5.0], "", None)])
        assert rows(mutate.update(base, blank, small))["a"] == ([5.0, 5.0], "text a", {"x": 1, "y": "q"})

    def test_upsert(self, spark, small, promote):
        base = start(spark, [A, B], promote)
        new = records_frame(spark, [Record("b", [2.0, 2.0], None, {"up": True}), Record("c", [3.0, 3.0], "c", {"x": 7, "n": None})])
        once = mutate.upsert(base, new, 1, small)
        assert rows(once) == {
            "a": rows(base)["a"],
            "b": ([2.0, 2.0], "text b", {"x": 2, "up": True}),
            "c": ([3.0, 3.0], "c", {"x": 7}),
        }
        assert rows(mutate.upsert(once, new, 2, small)) == rows(once)
        order = {r["id"]: (r["_batch"], r["_pos"]) for r in once.collect()}
        assert order == {"a": (0, 0), "b": (0, 1), "c": (1, 1)}

    def test_add_then_delete_restores(self, spark, small, promote):
        base = start(spark, [A, B], promote)
        more = mutate.add(base, records_frame(spark, [Record("c", [1.0, 1.0])]), 1, small)
        gone = spark.createDataFrame([("c",), ("nope",)], "id string")
        assert rows(mutate.delete(more, ids=gone, small=small)) == rows(base)


def test_delete_forms(spark):
    base = start(spark, [A, B, Record("c", [1.0, 1.0], "fox", {"x": 3, "status": "delete"})])
    assert set(rows(mutate.delete(base, ids=["a", "nope"]))) == {"b", "c"}
    assert set(rows(mutate.delete(base, ids=[]))) == {"a", "b", "c"}
    assert set(rows(mutate.delete(base, where={"status": "delete"}))) == {"a", "b"}
    assert set(rows(mutate.delete(base, where_document={"$contains": "fox"}))) == {"a", "b"}
    assert set(rows(mutate.delete(base, ids=["a", "c"], where={"x": {"$gt": 1}}))) == {"a", "b"}
    frame = spark.createDataFrame([("a",), ("c",), ("c",)], "id string")
    assert set(rows(mutate.delete(base, ids=frame, where={"x": {"$gt": 1}}))) == {"a", "b"}
    with pytest.raises(ValidationError):
        mutate.delete(base)


def test_validation(spark):
    def check(*records, **options):
        return mutate.validate_batch(records_frame(spark, records), **options)

    assert check(A, B).dim == 2
    assert check(A, B, dim=2).rows == 2
    assert check().rows == 0
    assert check(Record("a", None, "x"), embedding_required=False).dim is None
    for bad in ([Record(None, [1.0])], [Record("", [1.0])], [A, A], [A, Record("c", [1.0])], [Record("c", [])], [Record("c", None, "x")]):
        with pytest.raises(ValidationError):
            check(*bad)
    with pytest.raises(ValidationError):
        check(A, dim=3)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("promote", ["", "x int", "x int, _odd boolean"])
def test_values_that_do_not_fit_a_promoted_key_stay(spark, small, promote):
    given = {"a": "2021", "b": 2021.5, "c": 2**40, "d": 7, "e": True, "f": None}
    base = start(spark, [Record(i, [1.0], "t", {"x": v}) for i, v in given.items()], promote)

    def held(df):
        return {i: r[2].get("x") for i, r in rows(df.drop("_odd")).items()}

    assert held(base) == given
    tests = [({"x": "2021"}, "a"), ({"x": {"$gt": 100}}, "bc"), ({"x": True}, "e"), ({"x": {"$in": [7, 2**40]}}, "cd"), ({"x": {"$ne": 7}}, "abcef")]
    for where, wanted in tests:
        assert "".join(sorted(r["id"] for r in get_ops.get(base, where=where).collect())) == wanted
    changes = {"a": 5, "b": None, "c": "new", "d": "text", "e": 9}
    batch = records_frame(spark, [Record(i, None, None, {"x": v}) for i, v in changes.items()])
    assert held(mutate.update(base, batch, small)) == {**changes, "f": None}
    batch = records_frame(spark, [Record(i, [2.0], None, {"x": v}) for i, v in {**changes, "z": "odd", "y": 3}.items()])
    assert held(mutate.upsert(base, batch, 1, small)) == {**changes, "f": None, "z": "odd", "y": 3}


@pytest.mark.parametrize("small", [True, False])
def test_columns_of_a_batch_become_metadata(spark, small):
    base = start(spark, [A, B], "x bigint")
    new = spark.sql("SELECT 'c' AS id, array(1.0F) AS embedding, 'ann' AS author, 5L AS x, map('k', 'v', 'author', 'bob') AS metadata, 3L AS _pos")
    assert rows(mutate.add(base, new, 1, small))["c"] == ([1.0], None, {"author": "bob", "k": "v", "x": 5})
    text = spark.sql("""SELECT 'a' AS id, '{"n": 2.5, "y": null}' AS metadata, 9 AS level, 'many' AS x""")
    assert rows(mutate.update(base, text, small))["a"] == ([1.0, 0.0], "text a", {"n": 2.5, "level": 9, "x": "many"})
    nulls = spark.sql("SELECT 'n' AS id, array(1.0F) AS embedding, 5L AS x, CAST(NULL AS STRING) AS author, 1L AS _pos")
    assert rows(mutate.upsert(base, nulls, 1, small))["n"] == ([1.0], None, {"x": 5})


def test_conform(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("id"))
    assert conform(df, start(spark, [A])).columns == ["id", "embedding", "document", "metadata", "_batch", "_pos"]


def paged(spark, n, parts=4):
    """Positions with gaps, three batches."""
    frame = spark.range(n).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("_batch"), (F.col("id") * F.col("id")).alias("_pos")
    )
    return frame.repartition(parts)


def in_order(df):
    return [r["id"] for r in df.orderBy("_batch", "_pos").select("id").collect()]


@pytest.mark.parametrize("offset, cut", [(1, 0), (77, 0), (77, 5), (120, 5)])
def test_offset_without_limit(spark, monkeypatch, offset, cut):
    monkeypatch.setattr(get_ops, "MAX_TOP_ROWS", cut)
    monkeypatch.setattr(get_ops, "POSITION_RANGES", 4)
    df = paged(spark, 120)
    assert in_order(get_ops.page(df, offset=offset)) == in_order(df)[offset:]
    assert in_order(get_ops.page(df, limit=7, offset=offset)) == in_order(df)[offset : offset + 7]


@pytest.mark.parametrize("top", [0, 1, 10_000])
@pytest.mark.parametrize("kind", ["unique", "equal", "missing"])
def test_pages_are_alike_whatever_their_size(spark, monkeypatch, top, kind):
    monkeypatch.setattr(get_ops, "MAX_TOP_ROWS", top)
    monkeypatch.setattr(get_ops, "POSITION_RANGES", 5)
    pos = {"unique": F.col("id") * 7, "equal": F.lit(4).cast("bigint"), "missing": F.when(F.col("id") % 2 == 0, F.col("id"))}[kind]
    df = spark.range(60).select(F.col("id").cast("string").alias("id"), F.lit(0).cast("bigint").alias("_batch"), pos.alias("_pos")).repartition(3)
    whole = [r["id"] for r in df.orderBy("_batch", "_pos", "id").collect()]
    for limit, offset in [(50, 0), (7, 20), (60, 55), (0, 31), (5, 60)]:
        got = [r["id"] for r in get_ops.page(df, limit, offset).collect()]
        assert got == whole[offset : offset + limit if limit else None]


def test_pages_cover_the_whole(spark):
    df = paged(spark, 25)
    pages = [get_ops.page(df, limit=10, offset=o) for o in (0, 10, 20)]
    got = [i for p in pages for i in in_order(p)]
    assert got == in_order(df)
    last, keyed = None, []
    while True:
        rows = get_ops.page(df, limit=10, after=last).collect()
        if not rows:
            break
        keyed += [r["id"] for r in rows]
        last = (rows[-1]["_batch"], rows[-1]["_pos"])
    assert keyed == got
    with pytest.raises(ValidationError):
        get_ops.page(df, limit=-1)


def test_normalised_output(spark):
    df = as_collection(spark.createDataFrame([("a", ""), ("b", "x")], "id string, t string"), document="t")
    shown = {r["id"]: r for r in get_ops.normalise_output(df.withColumn("distance", F.lit(None).cast("double"))).collect()}
    assert df.filter("document IS NULL").count() == 1
    assert shown["a"]["document"] == "" and shown["a"]["metadata"] == {} and shown["a"]["distance"] == 0.0
    assert shown["b"]["document"] == "x"


keys = st.sampled_from("abcd")
scalars = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.sampled_from([0.5, 2.0]), st.sampled_from(["", "s"]))
records = st.dictionaries(
    st.sampled_from("pqrst"), st.tuples(st.sampled_from([None, "", "t1", "t2"]), st.dictionaries(keys, scalars, max_size=3)), max_size=4
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=records, new=records)
def test_upsert_matches_a_dictionary(spark, old, new):
    def listed(content, x):
        return [Record(i, [x, 1.0], text, meta) for i, (text, meta) in content.items()]

    base = start(spark, listed(old, 0.0))
    want = {}
    for i, (text, meta) in old.items():
        want[i] = ([0.0, 1.0], text or None, {k: v for k, v in meta.items() if v is not None})
    for i, (text, meta) in new.items():
        _, before, held = want.get(i, (None, None, {}))
        merged = {k: v for k, v in {**held, **meta}.items() if v is not None}
        want[i] = ([1.0, 1.0], text or before, merged)
    for small in (True, False):
        assert rows(mutate.upsert(base, records_frame(spark, listed(new, 1.0)), 1, small)) == want


@pytest.mark.parametrize("small", [True, False])
def test_a_small_batch_never_shuffles_the_collection(spark, tmp_path, small):
    path = f"file://{tmp_path}/base"
    start(spark, [A, B]).write.parquet(path)
    base, batch = spark.read.parquet(path), records_frame(spark, [Record("b", [2.0, 2.0], "x"), Record("c", [3.0, 3.0])])
    changed = [
        mutate.add(base, batch, 1, small),
        mutate.update(base, batch, small),
        mutate.upsert(base, batch, 1, small),
        mutate.delete(base, ids=batch.select("id"), small=small),
    ]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in changed]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for plan in plans:
        assert ("Exchange hashpartitioning" in plan) is (not small)
        assert ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan) is (not small)
