"""Record mutations: each takes a collection and a batch and returns the new collection.

The batch is measured first. Within the broadcast bound the collection is only scanned, never
shuffled; beyond it the two sides meet in one shuffle join on the (unique) id. A batch is read more than once, so
one that is costly to compute should be checkpointed or stored first, as `Collection` does.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.errors import ValidationError
from kinfold.functions.filters import Filter, document_column, where_column
from kinfold.functions.values import drop_nulls, from_json_text, merge, metadata_column, typed_slot, value_column
from kinfold.operators.get import MAX_ID_LITERALS, Ids, ids_frame
from kinfold.plans.sizing import broadcast_limit, fits, key_list, row_bytes
from kinfold.schema import METADATA, ODD, ORDER, RESERVED, empty_as_null, promoted_columns


@dataclass(frozen=True)
class BatchFacts:
    """What one pass over a batch tells: rows, bytes and the dimension of its vectors."""

    rows: int
    bytes: int
    dim: int | None


def validate_batch(batch: DataFrame, dim: int | None = None, embedding_required: bool = True) -> BatchFacts:
    """Check a batch: ids present and unique, vectors present (unless optional) and of one dimension.

    `dim` is the dimension of the collection, None if it has no vectors yet.
    """
    size = F.size("embedding")
    per_id = batch.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("embedding").alias("vectors"),
        F.min(F.when(F.col("embedding").isNotNull(), size)).alias("low"),
        F.max(F.when(F.col("embedding").isNotNull(), size)).alias("high"),
        F.sum(row_bytes(batch.schema)).alias("bytes"),
    )
    s = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("vectors"), F.lit(0)).alias("vectors"),
        F.max("n").alias("copies"),
        F.count_if(F.col("id").isNull() | (F.col("id") == "")).alias("unnamed"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    ).first()
    if s["unnamed"]:
        raise ValidationError("every record needs an id")
    if s["rows"] and s["copies"] > 1:
        raise ValidationError("an id occurs more than once in the batch")
    if embedding_required and s["vectors"] < s["rows"]:
        raise ValidationError("every record needs an embedding, or a text and an embedding function")
    if s["vectors"]:
        if s["low"] < 1:
            raise ValidationError("an embedding must not be empty")
        if s["low"] != s["high"]:
            raise ValidationError(f"embeddings differ in dimension: {s['low']} and {s['high']}")
        if dim is not None and s["low"] != dim:
            raise ValidationError(f"expected embeddings of dimension {dim}, got {s['low']}")
    return BatchFacts(s["rows"], s["bytes"], s["low"] if s["vectors"] else None)


def positions_serve(batch: DataFrame) -> bool:
    """Whether the batch's `_pos` are whole numbers, none missing and none twice."""
    if not isinstance(batch.schema["_pos"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return False
    per_pos = batch.groupBy("_pos").agg(F.count(F.lit(1)).alias("n"))
    return per_pos.agg(F.coalesce(F.max(F.when(F.col("_pos").isNull(), 2).otherwise(F.col("n"))), F.lit(0))).first()[0] <= 1


def is_small(batch: DataFrame, facts: BatchFacts) -> bool:
    return facts.bytes <= broadcast_limit(batch.sparkSession)


def _small(batch: DataFrame, small: bool | None) -> bool:
    return fits(batch) if small is None else small


def _offer(batch: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(batch) if small else batch


def with_all_metadata(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """`batch` with one typed metadata map that holds whatever the collection has no column for.

    Metadata may come as JSON text or as a map of plain values. Columns unknown to the collection, and
    columns of another type than its promoted ones, become keys of the map, which wins over them.
    """
    types = {f.name: f.dataType for f in schema.fields}
    given = F.lit(None).cast(METADATA)
    if "metadata" in batch.columns:
        dtype = batch.schema["metadata"].dataType
        given = F.col("metadata")
        if isinstance(dtype, T.StringType):
            given = from_json_text(given)
        elif isinstance(dtype, T.MapType) and not isinstance(dtype.valueType, T.StructType):
            given = F.map_filter(F.transform_values(given, lambda k, v: value_column(v, dtype.valueType)), lambda k, v: v.isNotNull())
        given = given.cast(METADATA)
    extra = [n for n in batch.columns if n not in RESERVED and types.get(n) != batch.schema[n].dataType]
    if extra:
        own = metadata_column(batch.schema, extra)
        both = F.map_zip_with(F.coalesce(given, F.create_map().cast(METADATA)), own, lambda k, g, o: F.coalesce(g, o))
        # Without any value, null metadata still means "unchanged".
        given = F.when(given.isNull() & (F.size(own) == 0), given).otherwise(both)
    elif "metadata" not in batch.columns:
        return batch
    return batch.withColumn("metadata", given).drop(*extra)


def _split(metadata: Column, columns: dict[str, Column]) -> Column:
    """The map without the keys that a promoted column holds; what does not fit the column stays."""
    if not columns:
        return metadata
    held = F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(n)) for n, c in columns.items()]))
    return F.map_filter(metadata, lambda k, v: ~F.array_contains(held, k))


def _is_odd(metadata: Column, promoted: list[str]) -> Column:
    """True where the map holds a promoted key, else null."""
    keys = F.map_keys(F.coalesce(metadata, F.create_map().cast(METADATA)))
    return F.when(F.exists(keys, lambda k: k.isin(promoted)), F.lit(True)) if promoted else F.lit(None).cast("boolean")


def _record_columns(batch: DataFrame, schema: T.StructType, batch_no: int, of: Callable[[str], Column]) -> dict[str, Column]:
    """Columns of a new record; `of` gives those of the batch, which has one metadata map."""
    have = set(batch.columns)
    out = {f.name: of(f.name) if f.name in have else F.lit(None) for f in schema.fields}
    out["_batch"] = F.lit(batch_no)
    if "document" in have:
        out["document"] = empty_as_null(of("document"))
    if "metadata" in have:
        columns = {}
        for f in schema.fields:
            if f.name not in RESERVED:
                given = of("metadata")[F.lit(f.name)]
                columns[f.name] = F.when(given.isNotNull(), typed_slot(given, f.dataType)).otherwise(out[f.name].cast(f.dataType))
        out |= columns
        out["metadata"] = _split(drop_nulls(of("metadata")), columns)
        if ODD in schema.fieldNames():
            out[ODD] = _is_odd(out["metadata"], list(columns))
    return {f.name: out[f.name].cast(f.dataType) for f in schema.fields}


def new_records(batch: DataFrame, schema: T.StructType, batch_no: int) -> DataFrame:
    """Batch rows as records of a collection: promoted keys out of the map, explicit nulls dropped."""
    batch = with_all_metadata(batch, schema)
    columns = _record_columns(batch, schema, batch_no, lambda c: F.col(f"`{c}`"))
    return batch.select(*[c.alias(n) for n, c in columns.items()])


def unknown_rows(base: DataFrame, batch: DataFrame, small: bool, few: bool = False) -> DataFrame:
    """Batch rows whose id is not in the collection.

    A small batch first looks up which of its ids exist, a scan of the collection's id column;
    the collection is not shuffled. `few` says that the collection's ids can be broadcast: then a large batch is not either.
    """
    if not small:
        ids = base.select("id")
        return batch.join(F.broadcast(ids) if few else ids, "id", "left_anti")
    known = base.select("id").join(F.broadcast(batch.select("id")), "id", "left_semi")
    return batch.join(F.broadcast(known), "id", "left_anti")


def add(base: DataFrame, batch: DataFrame, batch_no: int, small: bool | None = None) -> DataFrame:
    """Append the records whose id is new; records with a known id are left out.

    Only ids are ever broadcast, so only they are weighed.
    """
    fresh = unknown_rows(base, batch, _small(batch.select("id"), small))
    return base.unionByName(new_records(fresh, base.schema, batch_no))


def _changed(base: DataFrame, batch: DataFrame) -> dict[str, Column]:
    """New content of each column, over the join of base `o` and batch `n`. Null means unchanged."""
    old, new, have = (lambda c: F.col(f"o.`{c}`")), (lambda c: F.col(f"n.`{c}`")), set(batch.columns)
    out: dict[str, Column] = {}
    given_metadata = "metadata" in have
    for name in promoted_columns(base):
        dtype = base.schema[name].dataType
        value = F.coalesce(new(name).cast(dtype), old(name)) if name in have else old(name)
        if given_metadata:
            given = new("metadata")[F.lit(name)]
            value = F.when(given.isNotNull(), typed_slot(given, dtype)).otherwise(value)
        out[name] = value
    for name in base.columns:
        if name == "document":
            out[name] = F.coalesce(empty_as_null(new(name)), old(name)) if name in have else old(name)
        elif name == "embedding":
            out[name] = F.coalesce(new(name).cast(base.schema[name].dataType), old(name)) if name in have else old(name)
        elif name == "metadata":
            merged = merge(old(name), new(name)) if given_metadata else old(name)
            # A value that a column now holds leaves the map, also one of another type that stood there.
            out[name] = _split(merged, {n: out[n] for n in promoted_columns(base)})
    if ODD in base.columns:
        out[ODD] = _is_odd(out["metadata"], promoted_columns(base))
    return out


def update(base: DataFrame, batch: DataFrame, small: bool | None = None) -> DataFrame:
    """Change the records with the batch's ids. Unknown ids are ignored, null fields leave the old value."""
    batch = with_all_metadata(batch, base.schema)
    joined = base.alias("o").join(
        _offer(batch, _small(batch, small)).alias("n"), F.col("o.id") == F.col("n.id"), "left"
    )
    changed = _changed(base, batch)
    return joined.select(*[changed.get(c, F.col(f"o.`{c}`")).alias(c) for c in base.columns])


def upsert(base: DataFrame, batch: DataFrame, batch_no: int, small: bool | None = None, few: bool = False) -> DataFrame:
    """Change the records with known ids and append the others.

    Both parts are those of :func:`update` and :func:`add`, whatever the size of the batch. Rows of a large batch move
    once: only those with known ids if the collection's ids are `few` enough to be broadcast, else all in one join.
    """
    small = _small(batch, small)
    if not small and not few:
        return _merged(base, batch, batch_no)
    fresh = unknown_rows(base, batch, small, few)
    known = batch if small else batch.join(F.broadcast(base.select("id")), "id", "left_semi")
    return update(base, known, small).unionByName(new_records(fresh, base.schema, batch_no))


def _merged(base: DataFrame, batch: DataFrame, batch_no: int) -> DataFrame:
    """As :func:`upsert`, by one full join of two large sides."""
    batch = with_all_metadata(batch, base.schema)
    marked = base.withColumn("_known", F.lit(True))
    joined = marked.alias("o").join(batch.alias("n"), F.col("o.id") == F.col("n.id"), "full")
    changed = _changed(base, batch)
    fresh = _record_columns(batch, base.schema, batch_no, lambda c: F.col(f"n.`{c}`"))
    known = F.col("o._known").isNotNull()
    return joined.select(*[F.when(known, changed.get(c, F.col(f"o.`{c}`"))).otherwise(fresh[c]).alias(c) for c in base.columns])


def _id_column(ids: list[str]) -> Column:
    return F.col("id").isin([str(i) for i in ids]) if ids else F.lit(False)


def matching(
    base: DataFrame,
    ids: Ids = None,
    where: Filter = None,
    where_document: Filter = None,
) -> Column | None:
    """The rows a delete takes, as one two-valued column; None if ids must be joined instead."""
    tests = []
    if ids is not None:
        if isinstance(ids, DataFrame) or len(ids) > MAX_ID_LITERALS:
            return None
        tests.append(_id_column(list(ids)))
    if where is not None:
        tests.append(where_column(where, base))
    if where_document is not None:
        tests.append(document_column(where_document))
    if not tests:
        raise ValidationError("give at least one of ids, where and where_document")
    return reduce(operator.and_, tests)


def delete(
    base: DataFrame,
    ids: Ids = None,
    where: Filter = None,
    where_document: Filter = None,
    small: bool | None = None,
) -> DataFrame:
    """Remove the records that match all given arguments. Unknown ids are ignored."""
    taken = matching(base, ids, where, where_document)
    if taken is not None:
        return base.filter(~taken)
    listed = ids if isinstance(ids, DataFrame) else ids_frame(base, ids)
    listed = listed.select(F.col(listed.columns[0]).cast("string").alias("id"))
    offered = key_list(listed, small)
    if where is None and where_document is None:
        return base.join(offered, "id", "left_anti")
    also = F.lit(True)
    if where is not None:
        also = also & where_column(where, base)
    if where_document is not None:
        also = also & document_column(where_document)
    marked = base.withColumn("_also", also).alias("o")
    key = (F.col("o.id") == F.col("n.id")) & F.col("o._also")
    return marked.join(offered.alias("n"), key, "left_anti").drop("_also")
