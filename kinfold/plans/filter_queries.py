"""Filters (over promoted columns and over the metadata map) and gets by filter."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions.filters import Filter, Where
from kinfold.functions.values import metadata_column, typed_slot
from kinfold.operators import get as get_ops
from kinfold.plans.registry import DOCS, query
from kinfold.plans.tables import LABELS, Tables
from kinfold.schema import as_collection


def _from_map(df: DataFrame) -> DataFrame:
    """The labels out of the metadata map, as plain columns."""
    types = {"lang": "string", "source": "string", "n_chars": "bigint", "quality": "int", "toxic": "int"}
    return df.select("id", *[typed_slot(F.col("metadata")[n], T.DataType.fromDDL(types[n])).alias(n) for n in LABELS])


def _filter_query(name: str, where: Filter, sql: str) -> None:
    """One filter over promoted columns and the same over the metadata map."""
    full = f"WITH {DOCS} SELECT id, lang, source, n_chars, quality, toxic FROM docs WHERE {sql}"

    @query(name, full)
    def promoted(t: Tables) -> DataFrame:
        return get_ops.where(t.docs, where).drop("document", "metadata")

    @query(f"{name}_map", full)
    def in_map(t: Tables) -> DataFrame:
        return _from_map(get_ops.where(t.docs_in_map(), where))


_filter_query("c2_equals", Where().equals("lang", "fr"), "lang = 'fr'")
_filter_query("c3_eq", {"quality": {"$eq": 1}}, "quality = 1")
_filter_query("c4_ne", {"quality": {"$ne": 1}}, "quality IS DISTINCT FROM 1")
_filter_query("c5_gt", Where().greater_than("n_chars", 1000), "n_chars > 1000")
_filter_query("c6_gte", Where().greater_than_or_equal("n_chars", 1000.5), "n_chars >= 1000.5")
_filter_query("c7_lt", Where().less_than("n_chars", 1000), "n_chars < 1000")
_filter_query("c8_lte", Where().less_than_or_equal("lang", "es"), "lang <= 'es'")
_filter_query("c9_in", Where().is_in("lang", ["fr", "de", "xx"]), "lang IN ('fr', 'de', 'xx')")
_filter_query("c10_nin", Where().not_in("quality", [1, 5]), "(quality IS NULL OR quality NOT IN (1, 5))")
_filter_query(
    "c11_and",
    Where().and_(Where().equals("lang", "en"), Where().greater_than("n_chars", 300)),
    "lang = 'en' AND n_chars > 300",
)
_filter_query(
    "c12_or",
    Where().or_(Where().equals("lang", "en"), Where().less_than("n_chars", 300)),
    "lang = 'en' OR n_chars < 300",
)
_filter_query(
    "c13_chained",
    Where().equals("lang", "en").greater_than("n_chars", 300).less_than("n_chars", 2000),
    "lang = 'en' AND n_chars > 300 AND n_chars < 2000",
)
_filter_query(
    "c14_chained_or",
    Where().equals("toxic", 1).greater_than("n_chars", 3000).or_(),
    "coalesce(toxic = 1, false) OR n_chars > 3000",
)
_filter_query("c15_empty", Where(), "true")
_filter_query(
    "c16_nested",
    Where().and_(
        Where().or_(Where().equals("lang", "en"), Where().equals("lang", "de")),
        Where().or_(Where().equals("quality", 1), Where().not_in("toxic", [0, 1])),
    ),
    "(lang = 'en' OR lang = 'de') AND (coalesce(quality = 1, false) OR toxic IS NULL)",
)
_filter_query(
    "c17_json_text",
    '{"$or": [{"lang": "en", "n_chars": {"$gt": 500, "$lte": 900.0}}, {"toxic": {"$nin": [0]}}]}',
    "(lang = 'en' AND n_chars > 500 AND n_chars <= 900) OR toxic IS DISTINCT FROM 0",
)
_filter_query("c2_other_type", {"quality": "1"}, "false")


@query("c1_ids", f"WITH {DOCS} SELECT id, lang FROM docs WHERE id IN ('0', '17', '150')")
def ids(t: Tables) -> DataFrame:
    return get_ops.get(t.docs, ids=["0", "17", "150", "no-such-id"]).select("id", "lang")


@query(
    "c1_ids_frame",
    f"WITH {DOCS} SELECT id, lang FROM docs WHERE pos IN (SELECT vec_id FROM embeddings)",
)
def ids_frame(t: Tables) -> DataFrame:
    return get_ops.get(t.docs, ids=t["embeddings"].select("vec_id")).select("id", "lang")


@query("c18_contains", f"WITH {DOCS} SELECT id, document FROM docs WHERE contains(document, 'the')")
def document_contains(t: Tables) -> DataFrame:
    return get_ops.get(t.docs, where_document='{"$contains": "the"}').select("id", "document")


@query("c19_both", f"WITH {DOCS} SELECT id, lang FROM docs WHERE contains(document, 'the') AND lang = 'en'")
def both(t: Tables) -> DataFrame:
    return get_ops.get(t.docs, where={"lang": "en"}, where_document={"$contains": "the"}).select("id", "lang")


@query(
    "c20_where_page",
    f"WITH {DOCS} SELECT id, document, lang FROM docs WHERE n_chars > 200 ORDER BY pos LIMIT 25 OFFSET 5",
)
def where_page(t: Tables) -> DataFrame:
    rows = get_ops.where(t.docs, Where().greater_than("n_chars", 200), limit=25, offset=5)
    return rows.select("id", "document", "lang")


@query("c21_where_equals", f"WITH {DOCS} SELECT id, document FROM docs WHERE source = (SELECT min(source) FROM documents)")
def where_equals(t: Tables) -> DataFrame:
    source = t["documents"].agg(F.min("source")).first()[0]
    return get_ops.where_equals(t.docs, "source", source).select("id", "document")


_NOON = dt.datetime(2024, 1, 1, 12, 0)


def _events(t: Tables, promoted: bool) -> DataFrame:
    rows = t["events"]
    names = ["ts", "event_type", "value"]
    if promoted:
        return as_collection(rows, id="event_id", order="event_id", promote=names)
    return as_collection(
        rows, id="event_id", order="event_id", metadata=metadata_column(rows.schema, names)
    )


def _moment_query(name: str, promoted: bool) -> None:
    @query(
        name,
        "SELECT CAST(event_id AS VARCHAR) AS id FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-01 12:00:00' AND value < 20.5",
    )
    def moment(t: Tables) -> DataFrame:
        filter = Where().greater_than_or_equal("ts", _NOON).less_than("value", 20.5)
        return get_ops.where(_events(t, promoted), filter).select("id")


def _moments_query(name: str, promoted: bool, listed: bool) -> None:
    """Equality with a moment of the table, written without a zone or with another one."""
    first, last = "(SELECT min(ts) FROM events)", "(SELECT max(ts) FROM events)"

    @query(name, f"SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE ts IN ({first}{', ' + last if listed else ''})")
    def moments(t: Tables) -> DataFrame:
        low, high = t["events"].agg(F.min("ts").cast("timestamp_ntz"), F.max("ts").cast("timestamp_ntz")).first()
        away = high.replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=1)))
        return get_ops.get(_events(t, promoted), where={"ts": {"$in": [low, away]} if listed else low}).select("id")


_moments_query("c22_moment_equals", True, False)
_moments_query("c22_moment_equals_map", False, False)
_moments_query("c22_moment_in", True, True)
_moments_query("c22_moment_in_map", False, True)
_moment_query("c22_datetime", True)
_moment_query("c22_datetime_map", False)


def _flag_query(name: str, promoted: bool) -> None:
    @query(name, "SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE n_chars > 1000")
    def flag(t: Tables) -> DataFrame:
        rows = t["documents"].withColumn("is_long", F.col("n_chars") > 1000)
        if promoted:
            docs = as_collection(rows, id="doc_id", document="text", order="doc_id", promote=["is_long"])
        else:
            metadata = metadata_column(rows.schema, ["is_long"])
            docs = as_collection(rows, id="doc_id", document="text", order="doc_id", metadata=metadata)
        return get_ops.where_equals(docs, "is_long", True).select("id")


_flag_query("c23_boolean", True)
_flag_query("c23_boolean_map", False)


@query("c24_get_by_id", f"WITH {DOCS} SELECT id, document, lang FROM docs WHERE id = '42'")
def get_by_id(t: Tables) -> DataFrame:
    return get_ops.get_by_id(t.docs, "42").select("id", "document", "lang")


@query("c24_get_by_id_missing", f"WITH {DOCS} SELECT id, document FROM docs WHERE false")
def get_by_id_missing(t: Tables) -> DataFrame:
    return get_ops.get_by_id(t.docs, "no-such-id").select("id", "document")
