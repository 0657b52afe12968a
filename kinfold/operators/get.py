"""Scans, projections, paging and counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.errors import ValidationError
from kinfold.functions.filters import Filter, Where, apply_filters
from kinfold.plans.sizing import key_list
from kinfold.schema import METADATA, ORDER, promoted_columns

Ids = Union[Sequence[str], DataFrame, None]

# Above this many literals an id list becomes a joined DataFrame.
MAX_ID_LITERALS = 1000
# Up to this many rows, skipped ones included, a page is cut from one top-n.
MAX_TOP_ROWS = 10_000
# Ranges of positions counted in one step when a row is located.
POSITION_RANGES = 4096
# Insertion order; ids are unique, so they settle equal or missing positions.
KEY = (*ORDER, "id")


def ids_frame(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(i,) for i in dict.fromkeys(ids)], "id string")


def restrict_ids(df: DataFrame, ids: Ids, small: bool | None = None) -> DataFrame:
    """Keep the rows whose id is listed. Unknown ids match nothing; an empty list selects nothing."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("id"))
        return df.join(key_list(wanted, small), "id", "left_semi")
    ids = [str(i) for i in ids]
    if not ids:
        return df.filter(F.lit(False))
    if len(ids) <= MAX_ID_LITERALS:
        return df.filter(F.col("id").isin(ids))
    return df.join(key_list(ids_frame(df, ids)), "id", "left_semi")


def included_columns(
    df: DataFrame, embeddings: bool = False, metadatas: bool = True, documents: bool = True
) -> list[str]:
    """Names of the columns a result shows under the given include flags."""
    names = ["id"]
    if documents and "document" in df.columns:
        names.append("document")
    if metadatas:
        names += [*(["metadata"] if "metadata" in df.columns else []), *promoted_columns(df)]
    if embeddings:
        names.append("embedding")
    return names


def page(df: DataFrame, limit: int = 0, offset: int = 0, after: tuple | None = None) -> DataFrame:
    """One page in insertion order (ties by id, nulls first). A limit of 0 means no limit.

    A page near the start plans as one distributed top-n. Further on, or when it is large, the keys of
    its first row and of the row behind it are found from row counts, and the page is what lies
    between, sorted: no task ever holds skipped rows or the whole page. Either way the rows and their
    order are the same. `after` continues behind a known key (batch, position and, where positions
    repeat, id) and needs no offset. Without limit, offset and `after`, rows are not sorted.
    """
    if limit < 0 or offset < 0:
        raise ValidationError("limit and offset must not be negative")
    if after is not None:
        df = df.filter(~_before(after, inclusive=True))
    elif not limit and not offset:
        return df
    ordered = df.orderBy(*KEY)
    if limit and offset + limit <= MAX_TOP_ROWS:
        return (ordered.offset(offset) if offset else ordered).limit(limit)
    rows = df
    if offset:
        start = _key_at(df, offset)
        if start is None:
            return df.filter(F.lit(False))
        rows = rows.filter(~_before(start))
    if limit:
        end = _key_at(df, offset + limit)
        if end is not None:
            rows = rows.filter(_before(end))
    return rows.orderBy(*KEY)


def _before(key: tuple, inclusive: bool = False) -> Column:
    """Whether a row stands before a key, nulls first; `inclusive` counts rows with the key itself."""
    test = F.lit(inclusive)
    for name, value in reversed(list(zip(KEY, key))):
        column = F.col(name)
        if value is None:
            test = column.isNull() & test
        else:
            test = column.isNull() | (column < value) | ((column == value) & test)
    return F.coalesce(test, F.lit(False))


def _part_at(counts: DataFrame, skip: int) -> tuple[Any, int] | None:
    """(part, rows before it) of the part that holds row number `skip`, from counts `n` of few parts."""
    upto = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("upto", upto).filter(F.col("upto") > skip).orderBy("part").limit(1).collect()
    return (found[0]["part"], found[0]["upto"] - found[0]["n"]) if found else None


def _key_at(df: DataFrame, number: int) -> tuple | None:
    """The key of row `number` (from 0) in insertion order, None if there are fewer rows.

    The row is narrowed down by counts of ranges, at most POSITION_RANGES at a time: first of batch
    numbers, then of positions, then of ever longer beginnings of the ids. Once few rows are left they
    are sorted, so at most MAX_TOP_ROWS keys are ever brought together.
    """
    rows, skip = df.select(*KEY), number
    if rows.count() <= number:
        return None

    def settled() -> tuple | None:
        """The key itself, if the rows left are few."""
        if rows.limit(max(MAX_TOP_ROWS, 1) + 1).count() > max(MAX_TOP_ROWS, 1):
            return None
        return tuple(rows.orderBy(*KEY).offset(skip).limit(1).first())

    for name in ORDER:
        if (key := settled()) is not None:
            return key
        nulls = rows.filter(F.col(name).isNull())
        unknown = nulls.count()
        if skip < unknown:
            rows = nulls
            continue
        skip -= unknown
        rows = rows.filter(F.col(name).isNotNull())
        low, high = rows.agg(F.min(name), F.max(name)).first()
        while low < high:
            width = -(-(high - low + 1) // POSITION_RANGES)
            part = ((F.col(name) - low - F.pmod(F.col(name) - low, F.lit(width))) / width).cast("bigint")
            at, before = _part_at(rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")), skip)
            skip -= before
            low, high = low + at * width, min(high, low + (at + 1) * width - 1)
            rows = rows.filter(F.col(name).between(low, high))
    length = 0
    while (key := settled()) is None:
        length += 1
        start = F.substring("id", 1, length)
        at, before = _part_at(rows.groupBy(start.alias("part")).agg(F.count(F.lit(1)).alias("n")), skip)
        skip -= before
        rows = rows.filter(start == at)
    return key


def get(
    df: DataFrame,
    ids: Ids = None,
    where: Filter = None,
    where_document: Filter = None,
    limit: int = 0,
    offset: int = 0,
    include_embeddings: bool = False,
    include_metadatas: bool = True,
    include_documents: bool = True,
) -> DataFrame:
    """Records by ids, metadata filter and text filter (ANDed), optionally one page of them.

    A page comes back in insertion order. Without limit and offset the rows are unordered.
    """
    rows = apply_filters(restrict_ids(df, ids), where, where_document)
    rows = page(rows, limit, offset)
    return rows.select(*included_columns(df, include_embeddings, include_metadatas, include_documents))


def where(
    df: DataFrame, filter: Filter, limit: int = 0, offset: int = 0, include_embeddings: bool = False
) -> DataFrame:
    """Records that match a metadata filter, with metadata and text."""
    return get(df, where=filter, limit=limit, offset=offset, include_embeddings=include_embeddings)


def where_equals(
    df: DataFrame, field: str, value: object, limit: int = 0, offset: int = 0, include_embeddings: bool = False
) -> DataFrame:
    """Records whose field has one value."""
    return where(df, Where().equals(field, value), limit, offset, include_embeddings)


def get_by_id(df: DataFrame, id: str, include_embedding: bool = False) -> DataFrame:
    """The record with this id, or no row."""
    return get(df, ids=[id], include_embeddings=include_embedding).limit(1)


def count(df: DataFrame) -> DataFrame:
    """Number of records, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def normalise_output(df: DataFrame) -> DataFrame:
    """Result nulls as the reading side sees them: text "", metadata {}, distance 0.0."""
    shown: dict[str, Column] = {}
    if "document" in df.columns:
        shown["document"] = F.coalesce("document", F.lit(""))
    if "metadata" in df.columns:
        shown["metadata"] = F.coalesce("metadata", F.create_map().cast(METADATA))
    if "distance" in df.columns:
        shown["distance"] = F.coalesce("distance", F.lit(0.0))
    return df.withColumns(shown) if shown else df


def first_or_none(df: DataFrame, order: Iterable[str | Column]) -> DataFrame:
    """The first row in the given order, or no row."""
    return df.orderBy(*order).limit(1)
