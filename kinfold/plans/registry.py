"""Registration of queries over the test tables, each with its SQL equivalent where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinfold.plans.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Queries that SQL can't express, each with the reason.
WITHOUT_SQL: dict[str, str] = {}

# Common table expressions for the SQL side.
DOCS = """docs AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.doc_id AS pos, d.text AS document,
         d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
VECS = """vecs AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, vec_id AS pos, embedding, label FROM embeddings)"""
FULL = """full_docs AS (
  SELECT docs.*, e.embedding FROM docs JOIN embeddings e ON docs.pos = e.vec_id)"""


def hashed_words(dim: int, table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs that end in ``embedded(key, embedding)``: hashed bag of words of each text."""
    return f"""words AS (
  SELECT {key}, unnest(list_filter(string_split(regexp_replace(lower({text}), '\\p{{P}}', ' ', 'g'), ' '),
                                   lambda w: w <> '')) AS w
  FROM {table} WHERE regexp_matches({text}, '[^\\s\\p{{Z}}]')),
slots AS (
  SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dim} AS slot, count(*) AS n
  FROM words GROUP BY ALL),
totals AS (SELECT {key}, sum(n) AS total FROM slots GROUP BY {key}),
counts AS (
  SELECT {key}, map_from_entries(list((slot, n / CAST(total AS DOUBLE)))) AS m
  FROM slots JOIN totals USING ({key}) GROUP BY {key}),
raw_vectors AS (
  SELECT {key}, list_transform(range({dim}), lambda i: coalesce(element_at(m, i)[1], 0.0)) AS v
  FROM {table} LEFT JOIN counts USING ({key})),
lengths AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len FROM raw_vectors),
embedded AS (
  SELECT {key}, CAST(list_transform(v, lambda x: CASE WHEN len > 0 THEN x / len ELSE x END) AS FLOAT[]) AS embedding
  FROM lengths)"""


def l2(a: str, b: str) -> str:
    return (
        f"list_sum(list_transform(list_zip({a}, {b}), "
        "lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) ** 2))"
    )


def dot(a: str, b: str) -> str:
    return (
        f"list_sum(list_transform(list_zip({a}, {b}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"
    )


def ip(a: str, b: str) -> str:
    return f"(1.0 - {dot(a, b)})"


def cosine(a: str, b: str) -> str:
    norms = f"sqrt({dot(a, a)} * {dot(b, b)})"
    return f"(CASE WHEN {norms} = 0 THEN 1.0 ELSE 1.0 - {dot(a, b)} / {norms} END)"


def query(name: str, sql: str | None = None, reason: str = "") -> Callable:
    """Register a function of :class:`Tables` under `name`, with its SQL or the reason why there is none."""
    if (sql is None) != bool(reason):
        raise ValueError(f"{name} needs either SQL or a reason")

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        else:
            WITHOUT_SQL[name] = reason
        return build

    return register
