"""Conversions between result rows and one row of parallel arrays per query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.errors import ValidationError


def to_arrays(df: DataFrame, fields: dict[str, str], by: Sequence[str], rank: str = "rank") -> DataFrame:
    """Rows to parallel arrays in rank order, one row per group.

    `fields` maps a column to the name of its array, e.g. ``{"id": "ids"}``. `by` names the query, so
    that a group holds the at most k rows of one query and never the whole frame.
    """
    if not by:
        raise ValidationError("name the columns that tell queries apart")
    packed = F.sort_array(F.collect_list(F.struct(F.col(rank).alias("_rank"), *fields)))
    rows = df.groupBy(*by).agg(packed.alias("_rows"))
    return rows.select(*by, *[F.col("_rows")[c].alias(name) for c, name in fields.items()])


def to_rows(df: DataFrame, fields: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays to rows. `fields` maps an array to the name of its column.

    Shorter arrays are padded with nulls; the length of the first one decides the number of rows.
    """
    names = list(fields)
    zipped = F.arrays_zip(*[F.coalesce(F.col(a), F.array().cast(df.schema[a].dataType)).alias(a) for a in names])
    cut = F.slice(zipped, F.lit(1), F.size(F.coalesce(F.col(names[0]), F.array().cast(df.schema[names[0]].dataType))))
    rows = df.select(*by, F.posexplode(cut).alias("_at", "_row"))
    return rows.select(*by, (F.col("_at") + 1).alias("rank"), *[F.col("_row")[a].alias(c) for a, c in fields.items()])


def count(df: DataFrame) -> DataFrame:
    """Number of result rows."""
    return df.agg(F.count(F.lit(1)).alias("count"))
