"""Typed metadata values and JSON."""

import datetime as dt
import json
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kinfold.functions import values
from kinfold.schema import METADATA

GIVEN = {
    "string": "test",
    "int": 42,
    "long": 9223372036854775807,
    "bool": True,
    "null": None,
    "double": 2.718281828459,
    "decimal": Decimal("12345.6789"),
    "dateTime": dt.datetime(2023, 1, 1, 12, tzinfo=dt.timezone.utc),
    "dateTimeOffset": dt.datetime(2023, 1, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=2))),
    "guid": uuid.UUID("550e8400-e29b-41d4-a716-446655440000"),
    "list": ["a", 1],
    "quoted": 'say "hi"\n',
}


def frame(spark, metadata):
    from pyspark.sql import types as T

    return spark.createDataFrame([(values.pack_all(metadata),)], T.StructType([T.StructField("m", METADATA)]))


def test_to_json(spark):
    text = frame(spark, GIVEN).select(values.to_json_text(F.col("m"))).first()[0]
    got = json.loads(text)
    assert got["string"] == "test" and got["int"] == 42 and got["long"] == 9223372036854775807
    assert got["bool"] is True and got["null"] is None and got["double"] == 2.718281828459
    assert got["decimal"] == 12345.6789
    assert got["dateTime"] == "2023-01-01T12:00:00.0000000Z"
    assert got["dateTimeOffset"] == "2023-01-01T12:00:00.0000000+02:00"
    assert got["guid"] == "550e8400-e29b-41d4-a716-446655440000"
    assert json.loads(got["list"]) == ["a", 1] and got["quoted"] == 'say "hi"\n'


def test_round_trip(spark):
    df = frame(spark, GIVEN)
    back = df.select(values.from_json_text(values.to_json_text(F.col("m"))).alias("m")).first()["m"]
    before = values.unpack_all(df.first()["m"])
    assert values.unpack_all(back) == before


def test_from_json_types(spark):
    text = '{"s":"5","i":5,"d":2.5,"e":1e3,"big":18446744073709551615,"b":true,"n":null,"o":{"x":[1]},"a":[1,"2"]}'
    df = spark.createDataFrame([(text,)], "j string")
    got = df.select(values.from_json_text(F.col("j")).alias("m")).first()["m"]
    tags = {k: v["t"] for k, v in got.items()}
    assert tags == {"s": "s", "i": "i", "d": "d", "e": "d", "big": "d", "b": "b", "n": "n", "o": "s", "a": "s"}
    plain = values.unpack_all(got)
    assert plain["s"] == "5" and plain["i"] == 5 and plain["d"] == 2.5 and plain["e"] == 1000.0
    assert plain["big"] == 18446744073709551615.0 and plain["b"] is True
    assert json.loads(plain["o"]) == {"x": [1]} and json.loads(plain["a"]) == [1, "2"]


@pytest.mark.parametrize("text", [None, "", "   ", "{broken", "[1,2]", "5", '"x"', "{}"])
def test_bad_json_is_empty(spark, text):
    df = spark.createDataFrame([(text,)], "j string")
    assert df.select(values.from_json_text(F.col("j")).alias("m")).first()["m"] == {}


@pytest.mark.parametrize("text", ["{broken", "[1,2]"])
def test_bad_json_fails_fast(spark, text):
    df = spark.createDataFrame([(text,)], "j string")
    with pytest.raises(Exception):
        df.select(values.from_json_text(F.col("j"), "failfast")).collect()
    good = spark.createDataFrame([('{"a":1}',), ("",)], "j string")
    rows = good.select(values.from_json_text(F.col("j"), "failfast").alias("m")).collect()
    assert values.unpack_all(rows[0]["m"]) == {"a": 1} and rows[1]["m"] is None


def test_merge(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("o", METADATA), T.StructField("n", METADATA)])
    rows = [
        (values.pack_all({"a": 1, "b": "x"}), values.pack_all({"b": 2, "c": True})),
        (values.pack_all({"a": 1, "b": "x"}), values.pack_all({"a": None})),
        (None, values.pack_all({"a": None, "b": 1})),
        (values.pack_all({"a": 1}), None),
        (None, None),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(values.merge(F.col("o"), F.col("n"))).collect()]
    assert [values.unpack_all(m) for m in got[:4]] == [{"a": 1, "b": 2, "c": True}, {"b": "x"}, {"b": 1}, {"a": 1}]
    assert got[4] is None


def test_columns_of_every_type(spark):
    df = spark.sql(
        "SELECT 'x' AS s, CAST(3 AS SMALLINT) AS i, CAST(1.5 AS DECIMAL(5,2)) AS d, true AS b, "
        "TIMESTAMP '2023-01-01 12:00:00.123456' AS t, array(1, 2) AS a, CAST(NULL AS STRING) AS gone"
    )
    m = df.select(values.metadata_column(df.schema, df.columns)).first()[0]
    assert values.unpack_all(m) == {
        "s": "x", "i": 3, "d": 1.5, "b": True, "t": "2023-01-01T12:00:00.1234560Z", "a": "[1,2]",
    }


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_moments_are_written_in_utc(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = [0, -1, 1679794200123456, 1698539400000001, 1672574400000000]  # also hours that clocks skip or repeat
        df = spark.createDataFrame([(m,) for m in micros], "m long").select("m", values.iso_column(F.timestamp_micros("m")).alias("t"))
        for r in df.collect():
            at = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=r["m"])
            assert r["t"] == values.iso_text(at)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_python_values():
    import numpy as np

    assert values.primitive(np.int64(3)) == ("i", 3) and values.primitive(np.bool_(True)) == ("b", True)
    assert values.primitive(np.float32(0.5)) == ("d", 0.5) and values.primitive(np.str_("x")) == ("s", "x")
    assert values.primitive(dt.date(2024, 2, 3)) == ("s", "2024-02-03T00:00:00.0000000")


def test_single_precision_is_the_same_number(spark):
    df = spark.sql("SELECT 3.14F AS f")
    assert df.select(values.metadata_column(df.schema, ["f"])["f"]["d"]).first()[0] == 3.14
