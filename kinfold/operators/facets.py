"""Facets: how often each value of each metadata key occurs among the records of a result."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.errors import ValidationError
from kinfold.schema import promoted_columns


def _tag(dtype: T.DataType) -> str:
    """The type tag of a promoted column, as values in the map have it."""
    if isinstance(dtype, T.BooleanType):
        return "b"
    return "d" if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)) else "i" if isinstance(dtype, T.IntegralType) else "s"


def _entry(key: Column, tag: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), tag.alias("type"), value.alias("value"))


def facets(records: DataFrame, keys: Iterable[str] | None = None, top: int = 10) -> DataFrame:
    """The `top` most frequent values of every key, or of the given keys: key, type, value, n, rank.

    Values are told apart by type (s, i, d, b) and shown as text; ties go by type and value. Explicit nulls and
    missing keys are no values. All keys are counted in one pass and one shuffle: each record gives its entries,
    which tasks sum up before they are sent, so a value in a large share of the records is one
    row per task. The cut to `top` starts on the map side too, so a key with unbounded values does not
    gather in one task.
    """
    if top < 1:
        raise ValidationError("the number of values must be at least 1")
    wanted = None if keys is None else list(keys)
    parts = []
    if "metadata" in records.columns:
        held = F.map_entries(F.coalesce("metadata", F.create_map().cast(records.schema["metadata"].dataType)))
        if wanted is not None:
            held = F.filter(held, lambda e: e["key"].isin(wanted))

        def shown(e: Column) -> Column:
            v = e["value"]
            return _entry(e["key"], v["t"], F.coalesce(v["s"], v["i"].cast("string"), v["d"].cast("string"), v["b"].cast("string")))

        parts.append(F.transform(held, shown))
    own = [c for c in promoted_columns(records) if wanted is None or c in wanted]
    if own:
        tags = {c: _tag(records.schema[c].dataType) for c in own}
        parts.append(F.array(*[_entry(F.lit(c), F.lit(tags[c]), F.col(f"`{c}`").cast("string")) for c in own]))
    if not parts:
        raise ValidationError("the records have no metadata")
    entries = records.select(F.explode(F.concat(*parts)).alias("e")).select("e.*").filter(F.col("value").isNotNull())
    counts = entries.groupBy("key", "type", "value").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("key").orderBy(F.desc("n"), "type", "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
