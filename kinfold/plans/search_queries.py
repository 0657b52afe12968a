"""Nearest-neighbour queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.distance import SPACES, distance, vector_literal
from kinfold.functions.embedding import HashedWords
from kinfold.functions.filters import Where
from kinfold.operators import approximate, facets, pairs, results, search
from kinfold.operators import quantised as quantising
from kinfold.plans.record_queries import stored_workspace
from kinfold.plans.registry import DOCS, FULL, VECS, cosine, hashed_words, ip, l2, query
from kinfold.plans.tables import Tables, rounded

QUERY = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"
HAS_THE = "contains(document, 'the')"
DIM = 64
# About one vector in ten has another within this distance.
RADIUS = 1.05


def _nearest(source: str, space: str = "l2", k: int = 10, columns: str = "id", condition: str = "true") -> str:
    """SQL for the k rows of `source` nearest to vector 0."""
    measure = {"l2": l2, "cosine": cosine, "ip": ip}[space]("embedding", "q")
    return f"""SELECT {columns}, round(d, 6) AS distance FROM (
  SELECT *, {measure} AS d FROM (SELECT *, {QUERY} AS q FROM {source} WHERE {condition}))
ORDER BY d, pos LIMIT {k}"""


@query("d1_knn", f"WITH {VECS} {_nearest('vecs', columns='id, label')}")
def knn(t: Tables) -> DataFrame:
    return search.knn(t.vecs, t.vector(0)).select("id", "label", rounded("distance"))


@query("d3_knn_where", f"WITH {VECS} {_nearest('vecs', columns='id, label', condition='label = 3')}")
def knn_where(t: Tables) -> DataFrame:
    return search.knn(t.vecs, t.vector(0), where={"label": 3}).select("id", "label", rounded("distance"))


@query(
    "d3_knn_where_map",
    f"WITH {DOCS}, {FULL} {_nearest('full_docs', columns='id, lang', condition='n_chars > 500')}",
)
def knn_where_map(t: Tables) -> DataFrame:
    docs = t.docs_in_map(["lang", "n_chars"]).drop("embedding")
    corpus = docs.join(t.vecs.select("id", "embedding"), "id")
    found = search.knn(corpus, t.vector(0), where={"n_chars": {"$gt": 500}})
    return found.select("id", F.col("metadata")["lang"]["s"].alias("lang"), rounded("distance"))


@query(
    "d4_knn_where_document",
    f"WITH {DOCS}, {FULL} {_nearest('full_docs', columns='id, document', condition=HAS_THE)}",
)
def knn_where_document(t: Tables) -> DataFrame:
    found = search.knn(t.full, t.vector(0), where_document='{"$contains": "the"}')
    return found.select("id", "document", rounded("distance"))


def _embedded_nearest(k: int, text: str, condition: str = "true") -> str:
    return f"""WITH queries AS (SELECT 0 AS qid, '{text}' AS text),
{hashed_words(DIM)},
wanted AS (SELECT embedding AS q FROM ({_one_text(text)}))
SELECT CAST(doc_id AS VARCHAR) AS id, lang, round(d, 6) AS distance FROM (
  SELECT doc_id, lang, {l2('embedding', 'q')} AS d
  FROM embedded JOIN documents USING (doc_id), wanted WHERE {condition})
ORDER BY d, doc_id LIMIT {k}"""


def _one_text(text: str) -> str:
    return f"WITH one AS (SELECT 0 AS qid, '{text}' AS text), {hashed_words(DIM, 'one', 'qid')} SELECT * FROM embedded"


TEXT = "the thin heron, that was in the rest"


@query("d2_knn_text", _embedded_nearest(10, TEXT))
def knn_text(t: Tables) -> DataFrame:
    words = HashedWords(DIM)
    return search.knn_text(t.embedded_docs(words), TEXT, words).select("id", "lang", rounded("distance"))


@query("d5_search", _embedded_nearest(7, TEXT, "lang IN ('fr', 'de')"))
def search_filtered(t: Tables) -> DataFrame:
    words = HashedWords(DIM)
    found = search.search(t.embedded_docs(words), TEXT, words, 7, Where().is_in("lang", ["fr", "de"]))
    return found.select("id", "lang", rounded("distance"))


@query("d6_search_equals", _embedded_nearest(10, TEXT, "lang = 'en'"))
def search_equals(t: Tables) -> DataFrame:
    words = HashedWords(DIM)
    found = search.search_equals(t.embedded_docs(words), TEXT, words, "lang", "en")
    return found.select("id", "lang", rounded("distance"))


# ------------------------------------------------------------------------- many queries

MEANS = """means AS (
  SELECT label AS qid, CAST(list(x ORDER BY place) AS FLOAT[]) AS q FROM (
    SELECT label, place, avg(CAST(x AS DOUBLE)) AS x FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place FROM embeddings)
    GROUP BY label, place)
  GROUP BY label)"""


def _joined(queries: str, space: str, k: int) -> str:
    measure = {"l2": l2, "cosine": cosine, "ip": ip}[space]("embedding", "q")
    return f"""SELECT qid, id, label, rank, round(d, 6) AS distance FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY d, pos) AS INTEGER) AS rank FROM (
    SELECT *, {measure} AS d FROM vecs, {queries}))
WHERE rank <= {k}"""


@query("d7_knn_join", f"WITH {VECS}, {MEANS} {_joined('means', 'l2', 10)}")
def knn_join(t: Tables) -> DataFrame:
    return search.knn_join(t.vecs, t.label_means()).select("qid", "id", "label", "rank", rounded("distance"))


@query(
    "d7_knn_self_join",
    f"WITH {VECS}, wanted AS (SELECT vec_id AS qid, embedding AS q FROM embeddings) {_joined('wanted', 'l2', 5)}",
)
def knn_self_join(t: Tables) -> DataFrame:
    queries = t["embeddings"].select(F.col("vec_id").alias("qid"), "embedding")
    return search.knn_join(t.vecs, queries, k=5).select("qid", "id", "label", "rank", rounded("distance"))


@query(
    "d7_knn_join_texts",
    f"""WITH {hashed_words(DIM)},
wanted AS (SELECT item_id AS qid, embedding AS q FROM (
  WITH {hashed_words(DIM, 'benchmark', 'item_id')} SELECT * FROM embedded))
SELECT qid, id, rank, round(d, 6) AS distance FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY d, doc_id) AS INTEGER) AS rank FROM (
    SELECT qid, doc_id, CAST(doc_id AS VARCHAR) AS id, {l2('embedding', 'q')} AS d FROM embedded, wanted))
WHERE rank <= 3""",
)
def knn_join_texts(t: Tables) -> DataFrame:
    words = HashedWords(DIM)
    found = search.knn_join_text(t.embedded_docs(words), t["benchmark"], words, k=3, qid="item_id")
    return found.select("qid", "id", "rank", rounded("distance"))


# ------------------------------------------------------------------------- distance functions


@query(
    "d8_distances",
    f"""WITH {VECS} SELECT id, round({l2('embedding', 'q')}, 6) AS l2, round({cosine('embedding', 'q')}, 6) AS cosine,
round({ip('embedding', 'q')}, 6) AS ip FROM (SELECT *, {QUERY} AS q FROM vecs)""",
)
def distances(t: Tables) -> DataFrame:
    q = vector_literal(t.vector(0))
    return t.vecs.select("id", *[rounded(distance(F.col("embedding"), q, s), s) for s in SPACES])


@query("d8_knn_cosine", f"WITH {VECS} {_nearest('vecs', 'cosine')}")
def knn_cosine(t: Tables) -> DataFrame:
    return search.knn(t.vecs, t.vector(0), space="cosine").select("id", rounded("distance"))


@query("d8_knn_ip", f"WITH {VECS} {_nearest('vecs', 'ip')}")
def knn_ip(t: Tables) -> DataFrame:
    return search.knn(t.vecs, t.vector(0), space="ip").select("id", rounded("distance"))


@query("d8_knn_join_cosine", f"WITH {VECS}, {MEANS} {_joined('means', 'cosine', 5)}")
def knn_join_cosine(t: Tables) -> DataFrame:
    found = search.knn_join(t.vecs, t.label_means(), k=5, space="cosine")
    return found.select("qid", "id", "label", "rank", rounded("distance"))


@query("d10_more_than_matches", f"WITH {VECS} {_nearest('vecs', k=100000, condition='label = 3')}")
def more_than_matches(t: Tables) -> DataFrame:
    return search.knn(t.vecs, t.vector(0), k=100_000, where={"label": 3}).select("id", rounded("distance"))


@query("d10_no_matches", f"WITH {VECS} {_nearest('vecs', condition='label = -1')}")
def no_matches(t: Tables) -> DataFrame:
    return search.knn(t.vecs, t.vector(0), where={"label": -1}).select("id", rounded("distance"))


# ------------------------------------------------------------------------- stored collections


def _stored(t: Tables):
    """The vectors added to a stored collection as a batch without an order column."""
    made = stored_workspace(t).create_collection("vecs", promote={"label": "int"})
    made.add(t["embeddings"].select(F.col("vec_id").cast("string").alias("id"), "embedding", "label"))
    return made


@query("d1_stored_query", f"WITH {VECS} {_nearest('vecs')}")
def stored_query(t: Tables) -> DataFrame:
    return _stored(t).query(t.vector(0)).select("id", rounded("distance"))


@query("d1_stored_query_many_results", f"WITH {VECS} {_nearest('vecs', k=1001, condition='label < 100')}")
def stored_query_many_results(t: Tables) -> DataFrame:
    return _stored(t).query(t.vector(0), n_results=1001, where={"label": {"$lt": 100}}).select("id", rounded("distance"))


@query("d7_stored_query_many", f"WITH {VECS}, {MEANS} {_joined('means', 'l2', 5)}")
def stored_query_many(t: Tables) -> DataFrame:
    found = _stored(t).query_many(vectors=t.label_means(), n_results=5)
    return found.select("qid", "id", "label", "rank", rounded("distance"))


# ------------------------------------------------------------------------- approximate


@query("d9_approximate", "SELECT DISTINCT label AS qid, CAST(10 AS BIGINT) AS hits, true AS exact FROM embeddings")
def approximate_join(t: Tables) -> DataFrame:
    cells = approximate.train_cells(t.vecs, cells=16, iterations=5)
    assigned = approximate.assign_cells(t.vecs, cells)
    found = approximate.approximate_knn_join(assigned, cells, t.label_means(), k=10, probes=4)
    # Which rows it finds is its own affair; that there are k, at their true distance, is not.
    means = t.label_means().withColumnRenamed("embedding", "q")
    stored = t.vecs.select("id", F.col("embedding").alias("v"))
    true = F.aggregate(F.zip_with("q", "v", lambda a, b: a.cast("double") - b), F.lit(0.0), lambda s, x: s + x * x)
    held = found.select("qid", "id", "distance").join(stored, "id").join(means, "qid")
    same = F.abs(F.col("distance") - true) < 1e-6
    return held.groupBy("qid").agg(F.count(F.lit(1)).alias("hits"), F.every(same).alias("exact"))


def quantised(t: Tables, queries: DataFrame, k: int = 10, target: float = 0.9) -> DataFrame:
    """Hits of an index of product codes over all vectors, with the effort tuned to a share of true neighbours."""
    cells = approximate.train_cells(t.vecs, cells=16, iterations=5)
    quantiser = quantising.train_quantiser(t.vecs, cells, parts=16)
    search.ensure_checkpoint_dir(t.vecs)
    index = quantising.encode(t.vecs, quantiser).checkpoint()
    effort = quantising.tune(t.vecs, quantiser, index, queries, k=k, target=target)
    return quantising.search(t.vecs, index, quantiser, effort, queries, k)


def quantised_recall(t: Tables) -> DataFrame:
    """Every vector as a query: expected and found true neighbours, and their share."""
    queries = t["embeddings"].select(F.col("vec_id").alias("qid"), "embedding")
    return approximate.recall(quantised(t, queries), search.knn_join(t.vecs, queries, k=10))


@query("d9_recall", "SELECT count(*) * least(10, count(*)) AS expected, true AS at_least_0_9 FROM embeddings")
def recall_of_all_vectors(t: Tables) -> DataFrame:
    """The figure itself depends on the trained codes; the bench prints it."""
    return quantised_recall(t).select("expected", (F.col("recall") >= 0.9).alias("at_least_0_9"))


@query("d9_quantised", f"WITH {VECS}, {MEANS}, exact AS ({_joined('means', 'l2', 10)}) SELECT qid, count(*) AS hits, true AS true_distances FROM exact GROUP BY qid")
def quantised_means(t: Tables) -> DataFrame:
    means = t.label_means()
    found = quantised(t, means)
    stored = t.vecs.select("id", F.col("embedding").alias("v"))
    held = found.join(stored, "id").join(means.withColumnRenamed("embedding", "q"), "qid")
    same = F.abs(F.col("distance") - distance(F.col("q"), F.col("v"), "l2")) < 1e-6
    return held.groupBy("qid").agg(F.count(F.lit(1)).alias("hits"), F.every(same).alias("true_distances"))


@query("d9_all_cells", f"WITH {VECS}, {MEANS} {_joined('means', 'l2', 10)}")
def approximate_all_cells(t: Tables) -> DataFrame:
    cells = approximate.train_cells(t.vecs, cells=8, iterations=3)
    assigned = approximate.assign_cells(t.vecs, cells)
    found = approximate.approximate_knn_join(assigned, cells, t.label_means(), k=10, probes=8)
    return found.select("qid", "id", "label", "rank", rounded("distance"))


@query("d9_stored_cells", f"WITH {VECS}, {MEANS} {_joined('means', 'l2', 10)}")
def stored_cells(t: Tables) -> DataFrame:
    """Cells trained once and stored; the search reads them back and, visiting all of them, is exact."""
    path = f"{stored_workspace(t).root}/cells"
    approximate.write_cells(t.vecs, approximate.train_cells(t.vecs, cells=8, iterations=3), path)
    records, cells = approximate.read_cells(t.spark, path)
    found = approximate.approximate_knn_join(records, cells, t.label_means(), k=10, probes=8)
    return found.select("qid", "id", "label", "rank", rounded("distance"))


@query("d9_pruned_exact", f"WITH {VECS}, {MEANS} {_joined('means', 'l2', 10)}")
def pruned_exact(t: Tables) -> DataFrame:
    cells = approximate.train_cells(t.vecs, cells=16, iterations=3)
    assigned = approximate.assign_cells(t.vecs, cells)
    found = approximate.pruned_knn_join(
        assigned, approximate.with_radii(assigned, cells), t.label_means(), k=10, probes=2
    )
    return found.select("qid", "id", "label", "rank", rounded("distance"))


# ------------------------------------------------------------------------- filters over cells


def _in_cells(t: Tables, corpus: DataFrame):
    path = f"{stored_workspace(t).root}/filtered-cells"
    approximate.write_cells(corpus, approximate.train_cells(corpus, cells=16, iterations=3), path)
    return approximate.read_cells(t.spark, path)


@query("d3_knn_where_cells", f"WITH {VECS} {_nearest('vecs', columns='id, label', condition='label = 3')}")
def knn_where_cells(t: Tables) -> DataFrame:
    records, cells = _in_cells(t, t.vecs)
    return approximate.widening_knn(records, cells, t.vector(0), where={"label": 3}).select("id", "label", rounded("distance"))


@query("d4_knn_where_document_cells", f"WITH {DOCS}, {FULL} {_nearest('full_docs', columns='id, document', condition=HAS_THE)}")
def knn_where_document_cells(t: Tables) -> DataFrame:
    records, cells = _in_cells(t, t.full)
    found = approximate.widening_knn(records, cells, t.vector(0), where_document={"$contains": "the"})
    return found.select("id", "document", rounded("distance"))


# ------------------------------------------------------------------------- facets


def _facets(source: str, keys: dict[str, str], top: int) -> str:
    """SQL for the most frequent values of the given keys (with their type tags) in `source`."""
    counts = " UNION ALL ".join(
        f"SELECT '{k}' AS key, '{tag}' AS type, CAST({k} AS VARCHAR) AS value, count(*) AS n FROM {source} WHERE {k} IS NOT NULL GROUP BY {k}"
        for k, tag in keys.items()
    )
    return f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY n DESC, type, value) AS INTEGER) AS rank FROM ({counts})) WHERE rank <= {top}"""


@query(
    "x2_facets",
    f"WITH {DOCS}, matching AS (SELECT * FROM docs WHERE n_chars > 500) "
    + _facets("matching", {"lang": "s", "source": "s", "n_chars": "i", "quality": "i", "toxic": "i"}, 5),
)
def facets_of_filtered(t: Tables) -> DataFrame:
    rows = search.apply_filters(t.docs_in_map(), {"n_chars": {"$gt": 500}})
    return facets.facets(rows, top=5)


@query(
    "x2_facets_knn",
    f"WITH {VECS}, hits AS ({_nearest('vecs', k=100, columns='id, label')}) " + _facets("hits", {"label": "i"}, 10),
)
def facets_of_hits(t: Tables) -> DataFrame:
    return facets.facets(search.knn(t.vecs, t.vector(0), k=100, include_distances=False), ["label"])


# ------------------------------------------------------------------------- pairs under a threshold


@query(
    "x3_range_join",
    f"""WITH RECURSIVE {VECS}, near AS (
  SELECT a.id AS a, b.id AS b FROM vecs a, vecs b WHERE a.id <> b.id AND {l2('a.embedding', 'b.embedding')} <= {RADIUS}::DOUBLE * {RADIUS}),
reached AS (SELECT id AS a, id AS b FROM vecs UNION SELECT r.a, n.b FROM reached r JOIN near n ON r.b = n.a),
links AS (SELECT a, count(*) AS links FROM near GROUP BY a)
SELECT r.a AS id, coalesce(any_value(links), 0) AS links, min(r.b) AS class_id
FROM reached r LEFT JOIN links l ON r.a = l.a GROUP BY r.a""",
)
def range_join(t: Tables) -> DataFrame:
    return pairs.range_join(t.vecs, RADIUS)


# ------------------------------------------------------------------------- result shapes


@query("b2_include_flags", f"WITH {VECS} SELECT id, label FROM (SELECT *, {l2('embedding', 'q')} AS d FROM (SELECT *, {QUERY} AS q FROM vecs)) ORDER BY d, pos LIMIT 10")
def include_flags(t: Tables) -> DataFrame:
    found = search.knn(t.vecs, t.vector(0), include_documents=False, include_distances=False)
    return found.select("id", "label")


@query(
    "b4_to_arrays",
    f"""WITH {VECS}, {MEANS}, hits AS ({_joined('means', 'l2', 10)})
SELECT qid, string_agg(id, ',' ORDER BY rank) AS ids, string_agg(label, ',' ORDER BY rank) AS labels
FROM hits GROUP BY qid""",
)
def to_arrays(t: Tables) -> DataFrame:
    found = search.knn_join(t.vecs, t.label_means())
    packed = results.to_arrays(found, {"id": "ids", "label": "labels"}, by=["qid"])
    return packed.select("qid", F.array_join("ids", ",").alias("ids"), F.array_join("labels", ",").alias("labels"))


@query("b3_to_rows", f"WITH {VECS}, {MEANS} {_joined('means', 'l2', 10)}")
def to_rows(t: Tables) -> DataFrame:
    found = search.knn_join(t.vecs, t.label_means()).withColumn("distance", F.round("distance", 6))
    packed = results.to_arrays(found, {"id": "ids", "label": "labels", "distance": "distances"}, by=["qid"])
    return results.to_rows(packed, {"ids": "id", "labels": "label", "distances": "distance"}, by=["qid"])


@query("e2_result_count", "SELECT count(*) AS count FROM embeddings WHERE label = 3")
def result_count(t: Tables) -> DataFrame:
    return results.count(search.knn(t.vecs, t.vector(0), k=100_000, where={"label": 3}))
