"""Scans, paging, mutations, metadata values and embedding functions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.collection import Workspace
from kinfold.functions import values
from kinfold.functions.distance import l2_normalise
from kinfold.functions.embedding import BatchEmbedder, Constant, HashedWords, SeededRandom, embed_distinct, fill_embedding
from kinfold.functions.filters import Where, where_column
from kinfold.functions.text import contains, tokens
from kinfold.operators import get as get_ops
from kinfold.operators import mutate
from kinfold.operators.search import ensure_checkpoint_dir
from kinfold.plans.registry import DOCS, FULL, VECS, hashed_words, query
from kinfold.plans.sizing import spread
from kinfold.plans.tables import Tables, rounded
from kinfold.schema import METADATA, as_collection
from kinfold.streaming.ingest import upsert_stream

DIM = 64

# ------------------------------------------------------------------------- scans and sinks


@query("a1_full_scan", f"WITH {DOCS} SELECT id, document, lang, source, n_chars, quality, toxic FROM docs")
def full_scan(t: Tables) -> DataFrame:
    return get_ops.get(t.docs).drop("metadata")


def stored_workspace(t: Tables) -> Workspace:
    """A fresh folder under the shared checkpoint folder; a temporary one where none is set (tests)."""
    root = t.spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not t.spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="kinfold-")
    return Workspace(t.spark, f"{root}/workspace-{uuid.uuid4().hex}")


@query("a3_reopen", f"WITH {DOCS}, {FULL} SELECT id, document, lang, n_chars, CAST(len(embedding) AS INTEGER) AS dim FROM full_docs")
def reopen(t: Tables) -> DataFrame:
    space = stored_workspace(t)
    space.create_collection("docs", promote={"lang": "string", "n_chars": "bigint"}).add(t.full)
    stored = space.get_collection("docs").df
    return stored.select("id", "document", "lang", "n_chars", F.size("embedding").alias("dim"))


@query(
    "a2_stored_changes",
    f"""WITH {VECS}, {DOCS}, {hashed_words(DIM)},
updated AS (SELECT vecs.id, vecs.label, docs.lang, docs.document FROM vecs LEFT JOIN docs USING (id)),
added AS (SELECT docs.id, CAST(NULL AS INTEGER) AS label, docs.lang, docs.document FROM docs
          WHERE id NOT IN (SELECT id FROM vecs))
SELECT * FROM (SELECT * FROM updated UNION ALL SELECT * FROM added) WHERE label IS DISTINCT FROM 3""",
)
def stored_changes(t: Tables) -> DataFrame:
    words = HashedWords(DIM)
    space = stored_workspace(t)
    made = space.create_collection("mixed", words, promote={"label": "int", "lang": "string"})
    made.add(t.vecs)
    made.upsert(as_collection(t["documents"], id="doc_id", document="text", order="doc_id", promote=["lang"]))
    made.delete(where={"label": 3})
    return space.get_collection("mixed").df.select("id", "label", "lang", "document")


@query(
    "a7_from_json",
    "SELECT event_id, 'i' AS tag, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE props IS NOT NULL",
)
def from_json(t: Tables) -> DataFrame:
    parsed = t["events"].select("event_id", values.from_json_text(F.col("props"))["k"].alias("v"))
    return parsed.select("event_id", F.col("v.t").alias("tag"), F.col("v.i").alias("k"))


@query(
    "a7_broken_json",
    "SELECT event_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS keys FROM events",
)
def broken_json(t: Tables) -> DataFrame:
    # Only clicks keep their text; the others become broken, empty or not an object.
    text = (
        F.when(F.col("event_type") == "click", F.col("props"))
        .when(F.col("event_id") % 3 == 0, F.substring("props", 1, 4))
        .when(F.col("event_id") % 3 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("["), F.col("props"), F.lit("]")))
    )
    return t["events"].select("event_id", F.size(values.from_json_text(text)).alias("keys"))


@query(
    "a8_to_json",
    f"""WITH {DOCS} SELECT id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars,
CAST(quality AS VARCHAR) AS quality, toxic IS NOT NULL AS has_toxic FROM docs""",
)
def to_json(t: Tables) -> DataFrame:
    text = t.docs_in_map().select("id", values.to_json_text(F.col("metadata")).alias("j"))
    fields = [F.get_json_object("j", f"$.{n}").alias(n) for n in ("lang", "source", "n_chars", "quality")]
    return text.select("id", *fields, F.get_json_object("j", "$.toxic").isNotNull().alias("has_toxic"))


# ------------------------------------------------------------------------- projections


@query("b1_defaults", f"WITH {DOCS}, {FULL} SELECT id, document, lang FROM full_docs")
def get_defaults(t: Tables) -> DataFrame:
    return get_ops.get(t.full).select("id", "document", "lang")


@query(
    "b1_embeddings_only",
    f"WITH {DOCS}, {FULL} SELECT id, CAST(len(embedding) AS INTEGER) AS dim, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM full_docs",
)
def get_embeddings(t: Tables) -> DataFrame:
    rows = get_ops.get(t.full, include_embeddings=True, include_metadatas=False, include_documents=False)
    return rows.select("id", F.size("embedding").alias("dim"), rounded(F.get("embedding", F.lit(0)).cast("double"), "first"))


@query("b5_first", f"WITH {DOCS} SELECT id, document FROM docs WHERE lang = 'fr' ORDER BY pos LIMIT 1")
def first_row(t: Tables) -> DataFrame:
    rows = get_ops.apply_filters(t.docs, Where().equals("lang", "fr"))
    return get_ops.first_or_none(rows, ["_batch", "_pos"]).select("id", "document")


@query(
    "b6_normalised",
    f"WITH {DOCS} SELECT id, CASE WHEN lang = 'fr' THEN '' ELSE document END AS document, 0 AS keys, CAST(0.0 AS DOUBLE) AS distance FROM docs",
)
def normalised(t: Tables) -> DataFrame:
    # Empty texts are stored as null and read back as empty; rows without metadata read as {}.
    emptied = t["documents"].withColumn("text", F.when(F.col("lang") == "fr", "").otherwise(F.col("text")))
    rows = as_collection(emptied, id="doc_id", document="text", order="doc_id")
    shown = get_ops.normalise_output(rows.withColumn("distance", F.lit(None).cast("double")))
    return shown.select("id", "document", F.size("metadata").alias("keys"), "distance")


# ------------------------------------------------------------------------- counts, paging


@query("e1_count", "SELECT count(*) AS count FROM documents")
def count(t: Tables) -> DataFrame:
    return get_ops.count(as_collection(t["documents"], id="doc_id", document="text", order="doc_id"))


@query("g1_limit", f"WITH {DOCS} SELECT id, document FROM docs ORDER BY pos LIMIT 20")
def limit(t: Tables) -> DataFrame:
    return get_ops.get(t.docs, limit=20).select("id", "document")


@query("g2_offset", f"WITH {DOCS} SELECT id, lang FROM docs ORDER BY pos OFFSET 123")
def offset(t: Tables) -> DataFrame:
    return get_ops.get(t.docs, offset=123).select("id", "lang")


@query("g3_page", f"WITH {DOCS} SELECT id, lang FROM docs ORDER BY pos LIMIT 15 OFFSET 10")
def page(t: Tables) -> DataFrame:
    return get_ops.get(t.docs, limit=15, offset=10).select("id", "lang")


@query(
    "g3_pages_by_key",
    f"WITH {DOCS} SELECT id, lang FROM docs WHERE pos > 99 ORDER BY pos LIMIT 50",
)
def page_by_key(t: Tables) -> DataFrame:
    return get_ops.page(t.docs, limit=50, after=(0, 99)).select("id", "lang")


@query("g3_deep_page", "SELECT CAST(event_id AS VARCHAR) AS id FROM events ORDER BY event_id LIMIT 40 OFFSET 9000")
def deep_page(t: Tables) -> DataFrame:
    return get_ops.get(as_collection(t["events"], id="event_id", order="event_id"), limit=40, offset=9000).select("id")


@query(
    "g3_large_page",
    """SELECT CAST(event_id AS VARCHAR) AS id, row_number() OVER (ORDER BY event_id) AS place
FROM (SELECT event_id FROM events ORDER BY event_id LIMIT 12000 OFFSET 100)""",
)
def large_page(t: Tables) -> DataFrame:
    """A page beyond the size of one top-n; its own order, numbered by a counter of rows in order, is checked too."""
    events = as_collection(t["events"], id="event_id", order="event_id")
    rows = get_ops.get(events, limit=12_000, offset=100).select("id")
    # The page comes sorted: partitions are ranges, and rows stand in order inside them.
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    return numbered.select("id", F.row_number().over(Window.orderBy("_at")).cast("bigint").alias("place"))


@query(
    "g3_page_without_order",
    "SELECT CAST(event_id AS VARCHAR) AS id FROM events ORDER BY CAST(event_id AS VARCHAR) LIMIT 11000 OFFSET 50",
)
def page_without_order(t: Tables) -> DataFrame:
    return get_ops.get(as_collection(t["events"], id="event_id"), limit=11_000, offset=50).select("id")


# ------------------------------------------------------------------------- mutations

_MIXED = """CASE doc_id % 4 WHEN 0 THEN 'i' WHEN 1 THEN 'd' WHEN 2 THEN 's' ELSE 'b' END"""


def _mixed_batch(t: Tables) -> DataFrame:
    """`documents` whose key `x` is an integer, a fraction, a text or a boolean, in turn."""
    n, kind = F.col("doc_id"), F.col("doc_id") % 4
    slots = [
        F.when(kind == 0, "i").when(kind == 1, "d").when(kind == 2, "s").otherwise("b").alias("t"),
        F.when(kind == 2, n.cast("string")).alias("s"),
        F.when(kind == 0, n).alias("i"),
        F.when(kind == 1, n + 0.5).alias("d"),
        F.when(kind == 3, n % 8 == 3).alias("b"),
    ]
    value = F.create_map(F.lit("x"), F.struct(*slots)).cast(METADATA)
    return t["documents"].select(n.cast("string").alias("id"), value.alias("metadata"), n.alias("_pos"))


def _mixed_answer(t: Tables, promote: bool, small: bool) -> DataFrame:
    """Which filters each record passes, and the value it holds, after an add."""
    base = as_collection(t["documents"].filter(F.lit(False)), id="doc_id")
    if promote:
        base = base.withColumns({"x": F.lit(None).cast("int"), "_odd": F.lit(None).cast("boolean")})
    rows = mutate.add(base, _mixed_batch(t), batch_no=0, small=small)
    tests = {"above": {"x": {"$gt": 100}}, "text": {"x": "102"}, "flag": {"x": True}, "listed": {"x": {"$in": [4, 5.5, "6", True]}}, "other": {"x": {"$ne": 8}}}
    shown = {n: where_column(w, rows) for n, w in tests.items()}
    held = F.col("metadata")["x"]["t"]
    tag = F.when(F.col("x").isNotNull(), "i").otherwise(held) if promote else held
    return rows.select("id", tag.alias("tag"), *[c.alias(n) for n, c in shown.items()])


MIXED = f"""SELECT CAST(doc_id AS VARCHAR) AS id, {_MIXED} AS tag,
CASE doc_id % 4 WHEN 0 THEN doc_id > 100 WHEN 1 THEN doc_id + 0.5 > 100 ELSE false END AS above,
doc_id = 102 AS text, doc_id % 8 = 3 AS flag, doc_id IN (4, 5, 6) OR doc_id % 8 = 3 AS listed, doc_id <> 8 AS other FROM documents"""


@query("a9_mixed_types", MIXED)
def mixed_types(t: Tables) -> DataFrame:
    return _mixed_answer(t, promote=False, small=True)


@query("a9_mixed_types_promoted", MIXED)
def mixed_types_promoted(t: Tables) -> DataFrame:
    return _mixed_answer(t, promote=True, small=True)


@query("a9_mixed_types_promoted_large_batch", MIXED)
def mixed_types_promoted_large(t: Tables) -> DataFrame:
    return _mixed_answer(t, promote=True, small=False)


@query("a9_extra_columns", f"WITH {DOCS} SELECT id, lang, n_chars, coalesce(quality, -1) AS quality FROM docs")
def extra_columns(t: Tables) -> DataFrame:
    """Columns that the collection does not know become metadata."""
    base = as_collection(t["documents"].filter(F.lit(False)), id="doc_id")
    batch = t.labelled().select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("_pos"), "lang", "n_chars", "quality")
    rows = mutate.add(base, batch, batch_no=0)
    value = F.col("metadata")
    return rows.select("id", value["lang"]["s"].alias("lang"), value["n_chars"]["i"].alias("n_chars"), F.coalesce(value["quality"]["i"], F.lit(-1)).cast("int").alias("quality"))


@query(
    "a8_float",
    "SELECT DISTINCT CAST(l_discount AS VARCHAR) AS text, CAST(l_discount AS DOUBLE) AS number FROM lineitem",
)
def float_values(t: Tables) -> DataFrame:
    """Single-precision numbers come out as the same number."""
    rows = t["lineitem"].select("l_discount", F.col("l_discount").cast("float").alias("f")).distinct()
    m = values.metadata_column(rows.schema, ["f"])
    return rows.select(F.col("l_discount").cast("string").alias("text"), m["f"]["d"].alias("number"))


def _embedded_batch(t: Tables) -> DataFrame:
    """`documents` with vectors as a batch, checkpointed because a mutation reads its batch several times."""
    made = as_collection(
        spread(t["documents"]),
        id="doc_id",
        embedding=HashedWords(DIM).embed(F.col("text")),
        document="text",
        order="doc_id",
    ).drop("metadata", "_batch")
    ensure_checkpoint_dir(made)
    return made.checkpoint()


@query(
    "h1_add",
    """SELECT CAST(vec_id AS VARCHAR) AS id, label, 0 AS batch, NULL AS document FROM embeddings
UNION ALL
SELECT CAST(doc_id AS VARCHAR), NULL, 1, text FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""",
)
def add(t: Tables) -> DataFrame:
    rows = mutate.add(t.vecs, _embedded_batch(t), batch_no=1)
    return rows.select("id", "label", F.col("_batch").cast("int").alias("batch"), "document")


def _label_batch(t: Tables) -> DataFrame:
    """`labels` as an update: a text for toxic ones (empty, so unchanged, for the others), metadata
    with the source taken out of the good ones."""
    rows = t["labels"].withColumn("document", F.when(F.col("toxic") == 1, "removed").otherwise(""))
    gone = F.when(
        F.col("quality") == 1,
        F.create_map(
            F.lit("source"),
            F.struct(
                F.lit("n").alias("t"),
                F.lit(None).cast("string").alias("s"),
                F.lit(None).cast("bigint").alias("i"),
                F.lit(None).cast("double").alias("d"),
                F.lit(None).cast("boolean").alias("b"),
            ),
        ),
    ).otherwise(F.create_map().cast(METADATA))
    given = values.metadata_column(rows.schema, ["quality", "toxic"])
    return rows.select(
        F.col("doc_id").cast("string").alias("id"),
        "document",
        F.map_concat(given, gone).alias("metadata"),
        F.col("doc_id").alias("_pos"),
    )


def _shown(df: DataFrame) -> DataFrame:
    types = {"lang": "string", "source": "string", "quality": "int", "toxic": "int"}
    shown = [values.typed_slot(F.col("metadata")[n], T.DataType.fromDDL(d)).alias(n) for n, d in types.items()]
    return df.select("id", "document", *shown)


UPDATED = f"""WITH {DOCS} SELECT id, CASE WHEN toxic = 1 THEN 'removed' ELSE document END AS document, lang,
CASE WHEN quality = 1 THEN NULL ELSE source END AS source, quality, toxic FROM docs"""


@query("h4_update", UPDATED)
def update(t: Tables) -> DataFrame:
    return _shown(mutate.update(t.docs_in_map(["lang", "source", "n_chars"]), _label_batch(t)))


@query("h4_update_promoted", UPDATED)
def update_promoted(t: Tables) -> DataFrame:
    base = t.docs.withColumns({"quality": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    changed = mutate.update(base, _label_batch(t))
    return changed.select("id", "document", "lang", "source", "quality", "toxic")


UPSERTED = """SELECT coalesce(d.doc_id, v.vec_id)::VARCHAR AS id, v.label, d.text AS document,
CASE WHEN v.vec_id IS NULL THEN 1 ELSE 0 END AS batch
FROM embeddings v FULL JOIN documents d ON v.vec_id = d.doc_id"""


@query("h4_update_large_batch", UPDATED)
def update_large(t: Tables) -> DataFrame:
    return _shown(mutate.update(t.docs_in_map(["lang", "source", "n_chars"]), _label_batch(t), small=False))


def _upserted(t: Tables, small: bool) -> DataFrame:
    rows = mutate.upsert(t.vecs, _embedded_batch(t), batch_no=1, small=small)
    return rows.select("id", "label", "document", F.col("_batch").cast("int").alias("batch"))


@query("h6_upsert", UPSERTED)
def upsert(t: Tables) -> DataFrame:
    rows = mutate.upsert(t.vecs, _embedded_batch(t), batch_no=1)
    return rows.select("id", "label", "document", F.col("_batch").cast("int").alias("batch"))


@query("h6_upsert_large_batch", UPSERTED)
def upsert_large(t: Tables) -> DataFrame:
    return _upserted(t, small=False)


@query(
    "h8_merge",
    f"""WITH {DOCS} SELECT id, lang, CASE WHEN quality = 1 THEN 'checked' ELSE source END AS source, n_chars,
CAST(list_filter(['lang', 'n_chars', 'quality', 'source', 'toxic'],
  lambda k: k IN ('lang', 'n_chars', 'source') OR (quality IS NOT NULL AND k = 'quality')) AS VARCHAR) AS keys FROM docs""",
)
def merge(t: Tables) -> DataFrame:
    rows = t.labelled().withColumn("checked", F.when(F.col("quality") == 1, "checked"))
    old = values.metadata_column(rows.schema, ["lang", "source", "n_chars"])
    new = values.metadata_column(rows.withColumn("source", F.col("checked")).schema, ["quality"])
    patch = F.map_filter(F.create_map(F.lit("source"), values.value_column(F.col("checked"), rows.schema["checked"].dataType)), lambda k, v: v.isNotNull())
    merged = values.merge(old, F.map_concat(new, patch.cast(METADATA)))
    shown = rows.select(F.col("doc_id").cast("string").alias("id"), merged.alias("m"))
    keys = F.concat(F.lit("["), F.array_join(F.sort_array(F.map_keys("m")), ", "), F.lit("]"))
    return shown.select(
        "id", F.col("m")["lang"]["s"].alias("lang"), F.col("m")["source"]["s"].alias("source"),
        F.col("m")["n_chars"]["i"].alias("n_chars"), keys.alias("keys"),
    )


@query("h9_delete_ids", f"WITH {DOCS} SELECT id, lang FROM docs WHERE id NOT IN ('0', '3', '44')")
def delete_ids(t: Tables) -> DataFrame:
    return mutate.delete(t.docs, ids=["0", "3", "44", "no-such-id"]).select("id", "lang")


@query("h9_delete_ids_frame", f"WITH {DOCS} SELECT id, lang FROM docs WHERE pos NOT IN (SELECT doc_id FROM labels)")
def delete_ids_frame(t: Tables) -> DataFrame:
    return mutate.delete(t.docs, ids=t["labels"].select("doc_id")).select("id", "lang")


@query("h10_delete_where", f"WITH {DOCS} SELECT id, quality FROM docs WHERE quality IS DISTINCT FROM 1")
def delete_where(t: Tables) -> DataFrame:
    return mutate.delete(t.docs, where={"quality": 1}).select("id", "quality")


@query("h11_delete_document", f"WITH {DOCS} SELECT id, document FROM docs WHERE NOT contains(document, 'the')")
def delete_document(t: Tables) -> DataFrame:
    return mutate.delete(t.docs, where_document={"$contains": "the"}).select("id", "document")


@query(
    "h12_delete_combined",
    f"""WITH {DOCS} SELECT id, lang FROM docs WHERE NOT (pos IN (SELECT doc_id FROM labels)
AND n_chars > 500 AND contains(document, 'the'))""",
)
def delete_combined(t: Tables) -> DataFrame:
    rows = mutate.delete(
        t.docs, ids=t["labels"].select("doc_id"), where={"n_chars": {"$gt": 500}}, where_document={"$contains": "the"}
    )
    return rows.select("id", "lang")


# ------------------------------------------------------------------------- scalar functions


@query("i1_iso_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' AS iso FROM events")
def iso_text(t: Tables) -> DataFrame:
    return t["events"].select("event_id", values.iso_column(F.col("ts")).alias("iso"))


@query(
    "i2_nested_as_json",
    """SELECT doc_id, '["' || lang || '","' || source || '"]' AS tags FROM documents""",
)
def nested_as_json(t: Tables) -> DataFrame:
    rows = t["documents"].select("doc_id", F.array("lang", "source").alias("tags"))
    return rows.select("doc_id", values.metadata_column(rows.schema, ["tags"])["tags"]["s"].alias("tags"))


@query(
    "i3_json_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'i' AS key_tag, 'd' AS price_tag,
l_extendedprice AS price FROM lineitem""",
)
def json_numbers(t: Tables) -> DataFrame:
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    text = F.to_json(F.struct(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("p")))
    parsed = rows.withColumn("m", values.from_json_text(text))
    return parsed.select(
        F.col("m")["k"]["i"].alias("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey",
        F.col("m")["k"]["t"].alias("key_tag"), F.col("m")["p"]["t"].alias("price_tag"),
        F.col("m")["p"]["d"].alias("price"),
    )


@query("i5_contains", "SELECT doc_id, contains(text, 'the') AS found FROM documents")
def text_contains(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", contains(F.col("text"), "the").alias("found"))


@query(
    "i6_tokens",
    """SELECT doc_id, CAST(len(w) AS INTEGER) AS n, md5(array_to_string(w, ' ')) AS digest FROM (
SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '\\p{P}', ' ', 'g'), ' '), lambda x: x <> '') AS w
FROM documents)""",
)
def tokenised(t: Tables) -> DataFrame:
    rows = t["documents"].select("doc_id", tokens(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ").cast("binary")).alias("digest"))


@query(
    "i7_normalised_vectors",
    """SELECT vec_id, place, round(CASE WHEN len > 0 THEN x / len ELSE x END, 6) + 0.0 AS x FROM (
  SELECT vec_id, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len, unnest(v) AS x,
         generate_subscripts(v, 1) AS place
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * label) AS v FROM embeddings))""",
)
def normalised_vectors(t: Tables) -> DataFrame:
    # Scaled by the label first: other lengths than one, and zero vectors for label 0.
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.col("label"))
    rows = t["embeddings"].select("vec_id", scaled.alias("v"))
    parts = rows.select("vec_id", F.posexplode(l2_normalise(F.col("v"))).alias("place", "x"))
    return parts.select("vec_id", (F.col("place") + 1).cast("bigint").alias("place"), (F.round("x", 6) + 0.0).alias("x"))


# ------------------------------------------------------------------------- embedding functions


def _components(df: DataFrame, key: str) -> DataFrame:
    # The outer form, because the inner one filters on the size and computes the vector again for it.
    parts = df.select(key, F.posexplode_outer("embedding").alias("place", "x"))
    return parts.select(key, (F.col("place") + 1).cast("bigint").alias("place"), rounded(F.col("x").cast("double"), "x"))


@query(
    "j1_batch_function",
    "SELECT doc_id, CAST(length(text) AS DOUBLE) AS chars, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS blanks FROM documents",
)
def batch_function(t: Tables) -> DataFrame:
    shape = BatchEmbedder(lambda texts: [[len(x), x.count(" ")] for x in texts])
    rows = t["documents"].select("doc_id", shape.embed(F.col("text")).alias("v"))
    return rows.select(
        "doc_id",
        F.get("v", F.lit(0)).cast("double").alias("chars"),
        F.get("v", F.lit(1)).cast("double").alias("blanks"),
    )


@query(
    "j2_fill_missing",
    f"""WITH {hashed_words(DIM)} SELECT d.doc_id, generate_subscripts(coalesce(e.embedding, w.embedding), 1) AS place,
round(CAST(unnest(coalesce(e.embedding, w.embedding)) AS DOUBLE), 6) AS x
FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id JOIN embedded w ON w.doc_id = d.doc_id""",
)
def fill_missing(t: Tables) -> DataFrame:
    rows = t["documents"].join(t["embeddings"], F.col("doc_id") == F.col("vec_id"), "left")
    filled = fill_embedding(F.col("embedding"), F.col("text"), HashedWords(DIM))
    return _components(rows.select("doc_id", filled.alias("embedding")), "doc_id")


@query(
    "j2_distinct_texts",
    f"""WITH {hashed_words(DIM)}, copied AS (
  SELECT doc_id, doc_id AS from_id FROM documents UNION ALL
  SELECT -1 - doc_id, (SELECT min(doc_id) FROM documents) FROM documents WHERE doc_id % 2 = 0)
SELECT c.doc_id, generate_subscripts(embedding, 1) AS place, round(CAST(unnest(embedding) AS DOUBLE), 6) AS x
FROM copied c JOIN embedded e ON c.from_id = e.doc_id""",
)
def distinct_texts(t: Tables) -> DataFrame:
    """All documents, and one text once more for every second of them: a text in a third of the rows."""
    rows = t["documents"].select("doc_id", "text")
    first = rows.agg(F.min_by("text", "doc_id").alias("text"))
    copies = rows.filter("doc_id % 2 = 0").select((F.lit(-1) - F.col("doc_id")).alias("doc_id")).withColumn("text", F.lit(first.first()["text"]))
    return _components(embed_distinct(rows.unionByName(copies), "text", HashedWords(DIM)).select("doc_id", "embedding"), "doc_id")


@query(
    "c1_stored_ids",
    f"WITH {DOCS} SELECT id, lang, n_chars FROM docs WHERE id IN ('0', '7', '41', '117', 'no such id')",
)
def stored_ids(t: Tables) -> DataFrame:
    """A list of ids looked up in a stored collection of several files; ranges of ids tell which to read."""
    made = stored_workspace(t).create_collection("docs", promote={"lang": "string", "n_chars": "bigint"})
    rows = t["documents"].select(F.col("doc_id").cast("string").alias("id"), "lang", "n_chars", F.array(F.lit(1.0)).cast("array<float>").alias("embedding"), "doc_id")
    middle = rows.approxQuantile("doc_id", [0.5], 0.01)[0]
    for part in (F.col("doc_id") <= middle, F.col("doc_id") > middle):
        made.add(rows.filter(part).drop("doc_id"))
    return made.get(ids=["0", "7", "41", "117", "no such id"]).select("id", "lang", "n_chars")


@query(
    "x1_stream_upsert",
    """SELECT CAST(user_id AS VARCHAR) AS id, arg_max(event_type, event_id) AS document,
round(arg_max(value, event_id), 6) AS value, max(event_id) AS event_id FROM events GROUP BY user_id""",
)
def stream_upsert(t: Tables) -> DataFrame:
    """`events` as a stream of three files, the last of them sent twice, into a collection with a record per user.

    Then the last micro-batch is replayed with other content, which the recorded number keeps out.
    """
    space = stored_workspace(t)
    made = space.create_collection("users", promote={"value": "double", "event_id": "bigint"})
    rows = t["events"].select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("document"),
        F.array(F.col("value").cast("float")).alias("embedding"),
        "value",
        "event_id",
        F.col("event_id").alias("_pos"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    for number in (0, 1, 2, 2):
        part = F.floor((F.col("event_id") - low) * 3 / (high - low + 1)) == number
        rows.filter(part).coalesce(1).write.mode("append").parquet(f"{space.root}/incoming")
    source = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{space.root}/incoming")
    writer = upsert_stream(source, made, f"{space.root}/progress", event_time="ts", delay="1 day")
    writer.trigger(availableNow=True).start().awaitTermination()
    ((name, last),) = made.version.streams.items()
    made.upsert(rows.limit(50).dropDuplicates(["id"]).drop("ts").withColumn("value", F.lit(-1.0)), stream=(name, last))
    return made.df.select("id", "document", rounded("value"), "event_id")


@query(
    "j4_hashed_words",
    f"""WITH {hashed_words(DIM)} SELECT doc_id, generate_subscripts(embedding, 1) AS place,
round(CAST(unnest(embedding) AS DOUBLE), 6) AS x FROM embedded""",
)
def hashed(t: Tables) -> DataFrame:
    rows = spread(t["documents"]).select("doc_id", HashedWords(DIM).embed(F.col("text")).alias("embedding"))
    return _components(rows, "doc_id")


@query(
    "j5_constant",
    """SELECT doc_id, 4 AS dim, CAST(0.1 AS DOUBLE) AS first FROM documents""",
)
def constant(t: Tables) -> DataFrame:
    rows = t["documents"].select("doc_id", Constant([0.1, 0.2, 0.3, 0.4]).embed(F.col("text")).alias("v"))
    return rows.select("doc_id", F.size("v").alias("dim"), rounded(F.get("v", F.lit(0)).cast("double"), "first"))


@query(
    "j6_seeded_random",
    """SELECT doc_id, i + 1 AS place, round(CAST(CAST(
  CAST('0x' || substr(md5('42|' || i || '|' || coalesce(text, '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS FLOAT) AS DOUBLE), 6) AS x
FROM documents, range(8) AS r(i)""",
)
def seeded_random(t: Tables) -> DataFrame:
    rows = t["documents"].select("doc_id", SeededRandom(8).embed(F.col("text")).alias("embedding"))
    return _components(rows, "doc_id")
