"""Size checks that decide whether a side of a join may be broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_SETTING = "kinfold.maxBroadcastBytes"
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_limit(spark: SparkSession) -> int:
    """Largest side, in bytes, that may be shipped to every executor."""
    return int(spark.conf.get(BROADCAST_SETTING, str(DEFAULT_BROADCAST_BYTES)))


def _width(c: Column, dtype: T.DataType) -> Column:
    """Upper estimate of the bytes a value takes."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c).cast("bigint"), F.lit(0)) + 16
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.NumericType):
        return F.greatest(F.size(c), F.lit(0)).cast("bigint") * 8 + 16
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)).cast("bigint"), F.lit(0)) * 2 + 64
    return F.lit(16).cast("bigint")


def row_bytes(schema: T.StructType) -> Column:
    total = F.lit(16).cast("bigint")
    for f in schema.fields:
        total = total + _width(F.col(f"`{f.name}`"), f.dataType)
    return total


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def measure(df: DataFrame) -> Size:
    """Rows and estimated bytes of `df` (one aggregation, partial per task)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("b")).first()
    return Size(row["n"], row["b"])


def fits(df: DataFrame) -> bool:
    return measure(df).bytes <= broadcast_limit(df.sparkSession)


def key_list(ids: DataFrame, small: bool | None = None) -> DataFrame:
    """A list of ids as the right side of a semi or anti join.

    A small one is broadcast. A large one is reduced to distinct ids first, partially in every task,
    so an id repeated in a large share of the list does not gather in one task of the join.
    """
    return F.broadcast(ids) if (fits(ids) if small is None else small) else ids.distinct()


def spread(df: DataFrame) -> DataFrame:
    """Redistribute input of few splits before costly work per row.

    A split without the start of a row group is empty, so a handful of splits can mean a single
    busy task. Tables of any size worth a cluster have far more splits and pass unchanged.
    """
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
