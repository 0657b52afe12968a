"""The record type of a collection and the projection that brings any DataFrame into it.

A collection is a DataFrame with the columns of :data:`RECORD`. Metadata lives in a map of typed
values. A key that is known up front can be kept as a plain top-level column instead (a *promoted*
column), so that filters on it reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One metadata value: a type tag and exactly one filled slot (none for an explicit null).
#   s string, i bigint, d double, b boolean, n null
VALUE = T.StructType(
    [
        T.StructField("t", T.StringType()),
        T.StructField("s", T.StringType()),
        T.StructField("i", T.LongType()),
        T.StructField("d", T.DoubleType()),
        T.StructField("b", T.BooleanType()),
    ]
)
METADATA = T.MapType(T.StringType(), VALUE)
EMBEDDING = T.ArrayType(T.FloatType())

RECORD = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("embedding", EMBEDDING),
        T.StructField("document", T.StringType()),
        T.StructField("metadata", METADATA),
        T.StructField("_batch", T.LongType()),
        T.StructField("_pos", T.LongType()),
    ]
)
# True where the map holds a value of a promoted key that does not fit its column, else null. Stored
# collections with promoted keys have it, so that a filter looks into the map only there.
ODD = "_odd"
RESERVED = (*RECORD.fieldNames(), ODD)
ORDER = ("_batch", "_pos")


def promoted_columns(df: DataFrame) -> list[str]:
    """Names of the metadata keys that `df` keeps as top-level columns."""
    return [c for c in df.columns if c not in RESERVED]


def empty_as_null(text: Column) -> Column:
    """An empty text is stored as null."""
    return F.when(text != "", text)


def as_collection(
    df: DataFrame,
    id: str | Column = "id",
    embedding: str | Column | None = None,
    document: str | Column | None = None,
    metadata: str | Column | None = None,
    order: str | Column | None = None,
    batch: int = 0,
    promote: Iterable[str] = (),
) -> DataFrame:
    """Project `df` onto the record schema.

    `order` is a bigint column that gives the insertion order inside the batch. It has to be a
    stored column, because generated row numbers differ between reruns of a lost task.
    """

    def pick(c: str | Column | None, dtype: T.DataType) -> Column:
        if c is None:
            return F.lit(None).cast(dtype)
        return (F.col(c) if isinstance(c, str) else c).cast(dtype)

    return df.select(
        pick(id, T.StringType()).alias("id"),
        pick(embedding, EMBEDDING).alias("embedding"),
        empty_as_null(pick(document, T.StringType())).alias("document"),
        pick(metadata, METADATA).alias("metadata"),
        F.lit(batch).cast("bigint").alias("_batch"),
        pick(order, T.LongType()).alias("_pos"),
        *[F.col(c) for c in promote],
    )


def conform(df: DataFrame, like: DataFrame | T.StructType) -> DataFrame:
    """Give `df` the columns of `like`, with nulls where it has none."""
    schema = like if isinstance(like, T.StructType) else like.schema
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
