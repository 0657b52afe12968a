"""Filters: builder, accepted forms, and results over promoted columns and the metadata map."""

import datetime as dt
import json
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kinfold.errors import FilterError
from kinfold.functions.filters import Where, document_column, where_column
from kinfold.functions.values import pack_all
from kinfold.operators import get as get_ops
from kinfold.operators import mutate
from kinfold.schema import RECORD

KINDS = ("reef", "dune", "fjord", "moor")
#: Sites of a survey, drawn by a rule. Every fifth lacks a depth, every seventh a kind.
SITES = [
    (
        f"s{n:02}",
        None if n % 9 == 8 else f"Site {n}: {'calm' if n % 2 else 'windy'} {KINDS[n * 5 % 4]}",
        {
            "visits": n * 7 % 23,
            "open": n % 3 == 0,
            **({} if n % 7 == 6 else {"kind": KINDS[n * 5 % 4]}),
            **({} if n % 5 == 4 else {"depth": (n * 13 % 40) / 4}),
        },
    )
    for n in range(40)
]


def make(spark, rows):
    return spark.createDataFrame(
        [(i, None, text, pack_all(m), 0, n) for n, (i, text, m) in enumerate(rows)], RECORD
    )


@pytest.fixture(scope="module")
def in_map(spark):
    return make(spark, SITES)


@pytest.fixture(scope="module")
def promoted(spark):
    return spark.createDataFrame(
        [(i, None, text, None, 0, n, m.get("kind"), m["visits"], m.get("depth"), m["open"]) for n, (i, text, m) in enumerate(SITES)],
        "id string, embedding array<float>, document string, metadata map<string,struct<t:string,s:string,i:bigint,d:double,b:boolean>>, "
        "_batch bigint, _pos bigint, kind string, visits bigint, depth double, open boolean",
    )


def _class(value):
    return "flag" if isinstance(value, bool) else "text" if isinstance(value, str) else "number"


def _same(a, b):
    return a is not None and _class(a) == _class(b) and a == b


TESTS = {
    "$eq": _same,
    "$ne": lambda a, b: not _same(a, b),
    "$in": lambda a, b: any(_same(a, x) for x in b),
    "$nin": lambda a, b: not any(_same(a, x) for x in b),
    "$gt": lambda a, b: a is not None and _class(a) == _class(b) and a > b,
    "$gte": lambda a, b: a is not None and _class(a) == _class(b) and a >= b,
    "$lt": lambda a, b: a is not None and _class(a) == _class(b) and a < b,
    "$lte": lambda a, b: a is not None and _class(a) == _class(b) and a <= b,
}


def holds(tree, values):
    """What a filter says of one record, in plain Python."""
    if "$and" in tree:
        return all(holds(part, values) for part in tree["$and"])
    if "$or" in tree:
        return any(holds(part, values) for part in tree["$or"])
    return all(
        TESTS[op](values.get(key), bound)
        for key, condition in tree.items()
        for op, bound in (condition if isinstance(condition, dict) else {"$eq": condition}).items()
    )


def expected(tree):
    return [i for i, _, values in SITES if holds(tree, values)]


REEF, DUNE = Where().equals("kind", "reef"), Where().equals("kind", "dune")
CASES = [
    Where(),
    REEF,
    Where().equals("open", True),
    Where().equals("open", 1),
    Where().equals("visits", "7"),
    Where().equals("visits", 7.0),
    Where().equals("visits", 7.5),
    Where().greater_than("visits", 11),
    Where().greater_than_or_equal("visits", 11).less_than("visits", 14.5),
    Where().less_than_or_equal("depth", 2.25),
    Where().greater_than("visits", float("-inf")),
    Where().greater_than("visits", float("inf")),
    Where().is_in("kind", ["moor", "fjord", "nowhere"]),
    Where().is_in("depth", [1, 2.5, "x", True]),
    Where().not_in("kind", ["reef"]),
    Where().equals("kind", "reef").less_than("depth", 4.0).greater_than("visits", 3),
    Where().equals("kind", "moor").less_than("depth", 1.0).or_(),
    Where().or_(REEF, DUNE),
    Where().or_(REEF, DUNE).equals("open", False),
    Where().and_(Where().or_(REEF, DUNE), Where().greater_than("depth", 5)),
    Where().or_(Where().and_(REEF, Where().equals("open", True)), Where().and_(DUNE, Where().equals("open", False))),
    {"kind": {"$ne": "dune"}},
    {"open": {"$ne": False}},
    {"visits": {"$ne": "3"}},
    {"unknown": {"$ne": 1}},
    {"unknown": {"$nin": [1, "a"]}},
    {"unknown": 1},
    {"kind": "fjord", "depth": {"$gte": 1, "$lt": 9}},
    {"$or": [{"visits": 0}, {"$and": [{"depth": {"$lte": 3}}, {"kind": {"$in": ["moor"]}}]}]},
]


@pytest.mark.parametrize("where", CASES, ids=str)
@pytest.mark.parametrize("kind", ["in_map", "promoted"])
def test_filter_results(request, ids, where, kind):
    df, tree = request.getfixturevalue(kind), where.to_dict() if isinstance(where, Where) else where
    forms = [where] if "inf" in str(tree).lower() else [where, json.dumps(tree)]
    for form in forms:
        assert sorted(ids(get_ops.get(df, where=form))) == expected(tree)


@pytest.mark.parametrize("where", CASES, ids=str)
def test_filter_and_complement_partition_the_rows(in_map, ids, where):
    test = where_column(where, in_map)
    assert in_map.filter(test.isNull()).count() == 0
    matching = expected(where.to_dict() if isinstance(where, Where) else where)
    assert sorted(ids(in_map.filter(~test)) + matching) == [i for i, _, _ in SITES]


def test_lists_are_stored_as_json_text(spark, ids):
    df = make(spark, [(f"t{n}", None, {"marks": list(range(n))}) for n in range(4)])
    assert ids(get_ops.get(df, where={"marks": "[0,1]"})) == ["t2"]


@pytest.mark.parametrize("needle", ["calm", "Calm", "Site 3", "dune", "", "zzz"])
def test_text_filter_and_delete(in_map, ids, needle):
    holding = [i for i, text, _ in SITES if text is not None and needle in text]
    condition = {"$contains": needle}
    assert sorted(ids(get_ops.get(in_map, where_document=condition))) == holding
    assert sorted(ids(get_ops.get(in_map, where_document=json.dumps(condition)))) == holding
    left = [i for i, _, _ in SITES if i not in holding]
    assert sorted(ids(mutate.delete(in_map, where_document=condition))) == left
    both = get_ops.get(in_map, where={"visits": {"$gte": 10}}, where_document=condition)
    assert sorted(ids(both)) == [i for i, _, m in SITES if i in holding and m["visits"] >= 10]


def test_unknown_text_operator():
    with pytest.raises(FilterError):
        document_column({"$regex": "x"})


def test_builder_shapes():
    assert Where().to_dict() == {}
    assert Where().equals("a", 1).to_dict() == {"a": 1}
    assert Where().greater_than("a", 1).to_dict() == {"a": {"$gt": 1}}
    assert Where().equals("a", 1).less_than("b", 2).to_dict() == {"$and": [{"a": 1}, {"b": {"$lt": 2}}]}
    assert Where().equals("a", 1).equals("b", 2).or_().to_dict() == {"$or": [{"a": 1}, {"b": 2}]}
    nested = Where().and_(Where().or_(Where().equals("a", 1), Where().equals("b", 2)), Where().equals("c", 3))
    assert nested.to_dict() == {"$and": [{"$or": [{"a": 1}, {"b": 2}]}, {"c": 3}]}


@pytest.mark.parametrize(
    "where",
    [
        {"$not": [{"a": 1}]},
        {"a": {"$like": "x"}},
        {"a": {}},
        {"$and": []},
        {"$or": {"a": 1}},
        {"a": {"$in": []}},
        {"a": {"$nin": "x"}},
        {"a": {"$gt": True}},
        "[1, 2]",
        "{broken",
    ],
)
def test_malformed_filters(in_map, where):
    with pytest.raises(FilterError):
        where_column(where, in_map)


def test_literal_types(spark, ids):
    key = uuid.UUID("550e8400-e29b-41d4-a716-446655440000")
    noon = dt.datetime(2023, 1, 1, 12, tzinfo=dt.timezone.utc)
    df = make(spark, [("a", "x", {"u": key, "t": noon, "n": Decimal("12345.6789"), "dots.in.name": 7})])
    for where in ({"u": key}, {"t": noon}, {"t": {"$gte": noon}}, {"n": Decimal("12345.6789")}, {"dots.in.name": 7}):
        assert ids(get_ops.get(df, where=where)) == ["a"]
    assert ids(get_ops.get(df, where={"t": {"$gt": noon}})) == []
    with pytest.raises(TypeError):
        where_column({"u": object()}, df)
    with pytest.raises(TypeError):
        where_column({"u": [1, 2]}, df)


def test_large_integers_compare_exactly(spark, ids):
    big = 2**53
    df = make(spark, [("a", "x", {"n": big}), ("b", "x", {"n": big + 1})])
    assert ids(get_ops.get(df, where={"n": big + 1})) == ["b"]
    assert sorted(ids(get_ops.get(df, where={"n": {"$gt": big}}))) == ["b"]


def test_promoted_filters_reach_the_scan(spark, tmp_path, promoted):
    path = f"file://{tmp_path}/sites"
    promoted.withColumn("_odd", F.lit(None).cast("boolean")).write.parquet(path)
    df = get_ops.get(
        spark.read.parquet(path),
        where={"visits": {"$gt": 9}, "kind": {"$ne": "x"}},
        where_document={"$contains": "calm"},
        include_metadatas=False,
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(visits,9)" in pushed and "StringContains(document,calm)" in pushed
    assert "embedding" not in plan[plan.index("ReadSchema") :]


def test_ids(in_map, ids, spark):
    assert ids(get_ops.get(in_map, ids=["s02", "zzz"])) == ["s02"]
    assert ids(get_ops.get(in_map, ids=[])) == []
    many = [f"x{i}" for i in range(2000)] + ["s01"]
    assert ids(get_ops.get(in_map, ids=many)) == ["s01"]
    frame = spark.createDataFrame([("s03",), ("s03",), ("q",)], "k string")
    assert ids(get_ops.get(in_map, ids=frame)) == ["s03"]
    assert ids(get_ops.get(in_map, ids=frame, where={"visits": 1})) == []


def test_first_and_by_id(in_map):
    assert get_ops.get_by_id(in_map, "nope").collect() == []
    assert get_ops.get_by_id(in_map, "s02").first()["document"] == SITES[2][1]
    assert get_ops.first_or_none(in_map, [F.desc("_pos")]).first()["id"] == "s39"
