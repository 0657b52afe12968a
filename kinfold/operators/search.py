"""Exact nearest-neighbour search.

The corpus is read once and never shuffled. Every task compares its Arrow batches with a block of
query vectors by one matrix product and keeps the k best rows per query, so what leaves a task is
k rows per query, whatever the size of the corpus. A top-n (one query) or a window per query (many)
merges these. Only the vector and the ordering columns travel to Python; texts and metadata are
joined to the few hits afterwards.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinfold.errors import ValidationError
from kinfold.functions.distance import SPACES
from kinfold.functions.embedding import Embedder
from kinfold.functions.filters import Filter, Where, apply_filters
from kinfold.operators.get import included_columns
from kinfold.plans.sizing import broadcast_limit
from kinfold.schema import ORDER

# Cells of one distance matrix inside a task (8 bytes each).
MATRIX_CELLS = 4_000_000
# Vector components taken from a batch at once.
VECTOR_CELLS = 4_000_000
# Values of one list in a filter that reaches Parquet, the default of
# spark.sql.parquet.pushdown.inFilterThreshold.
PUSHED_VALUES = 10
# Pairs that one task compares where many queries meet many records, and the records among them.
TASK_PAIRS = 1 << 31
SHARD_CELLS = 1 << 22
# Records that a query meets first in a task; each step after it takes four times as many.
FIRST_ROWS = 2048
# Rows of one result batch.
OUTPUT_ROWS = 50_000
# Stands for a missing batch number or position inside a task; sorts first, as null does.
NO_PLACE = np.iinfo(np.int64).min
# Assumed size of one hit when the hits are weighed for a broadcast.
HIT_BYTES = 256
# Tasks whose hits of one query are merged in one step.
MERGED_TASKS = 256
# Vector components recomputed at once when distances of kept pairs are made exact.
RECOMPUTE_CELLS = 8_000_000
# What a hit holds besides its query.
HIT_FIELDS = [
    T.StructField("id", T.StringType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("_batch", T.LongType()),
    T.StructField("_pos", T.LongType()),
]


@dataclass(frozen=True)
class QueryBlock:
    """Query vectors small enough to travel with the task, and optionally the cells each may visit."""

    qids: pa.Array
    vectors: np.ndarray
    space: str
    k: int
    visits: np.ndarray | None = None  # boolean, query x cell


# ------------------------------------------------------------------------ inside a task


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and not (lengths == dim).all():
        raise ValueError(f"expected vectors of {dim} components")
    return flat.astype(np.float64).reshape(len(column), dim)


def _rough(x: np.ndarray, q: np.ndarray, space: str) -> tuple[np.ndarray, np.ndarray]:
    """Distances (query x row) by one matrix product, and a bound of their rounding error per query."""
    xx, qq = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", q, q)
    slack = 1e-15 * (x.shape[1] + 8)
    reach = xx.max(initial=0.0)
    if space == "l2" and len(x) >= FIRST_ROWS and reach < 1e30 and qq.max(initial=0.0) < 1e30:
        # Single precision halves the time; its bound is wider, and pairs within it are measured exactly.
        left = np.column_stack([q * -2.0, np.ones(len(q)), qq]).astype(np.float32)
        right = np.column_stack([x, xx, np.ones(len(x))]).astype(np.float32)
        return left @ right.T, 4 * (1e-7 * (x.shape[1] + 8)) * (reach + qq) + 1e-35
    if space == "l2" and len(q) < 8:
        return xx[None, :] + qq[:, None] - 2.0 * (q @ x.T), 4 * slack * (reach + qq)
    if space == "l2":
        # |x - q|^2 = |x|^2 + |q|^2 - 2xq, with the first two terms as extra components of the product:
        # one pass over the large matrix instead of three.
        left = np.column_stack([q * -2.0, np.ones(len(q)), qq])
        return left @ np.column_stack([x, xx, np.ones(len(x))]).T, 4 * slack * (reach + qq)
    if space == "ip":
        return 1.0 - q @ x.T, 4 * slack * (1.0 + np.sqrt(reach * qq))
    with np.errstate(divide="ignore", invalid="ignore"):
        # Scaling first would lose zero vectors: their distance is 1 by definition.
        products = q @ x.T
        norms = np.sqrt(qq)[:, None] * np.sqrt(xx)[None, :]
        return np.where(norms == 0.0, 1.0, 1.0 - products / norms), np.full(len(q), 8 * slack)


def _exact(x: np.ndarray, q: np.ndarray, space: str) -> np.ndarray:
    """Distances of aligned pairs, summed alike for every pair: equal vectors get equal distances."""
    if space == "l2":
        return np.square(x - q).sum(axis=1)
    products = (x * q).sum(axis=1)
    if space == "ip":
        return 1.0 - products
    norms = np.sqrt(np.square(x).sum(axis=1) * np.square(q).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norms == 0.0, 1.0, 1.0 - products / norms)


def _exact_in_slices(x, q, rows, queries, space) -> np.ndarray:
    out = np.empty(len(rows))
    step = max(1, RECOMPUTE_CELLS // max(1, x.shape[1]))
    for at in range(0, len(rows), step):
        s = slice(at, at + step)
        out[s] = _exact(x[rows[s]], q[queries[s]], space)
    return out


def _first_copies(x: np.ndarray, batch: np.ndarray, pos: np.ndarray, k: int) -> np.ndarray:
    """Rows of `x` without those that have k equal vectors before them: they can never be hits."""
    # Rows as strings of bytes; adding zero makes -0.0 and 0.0 one.
    whole = np.ascontiguousarray(x + 0.0)
    _, group = np.unique(whole.view(f"V{whole.itemsize * whole.shape[1]}").ravel(), return_inverse=True)
    order = np.lexsort((pos, batch, group.ravel()))
    return np.sort(order[_rank_within(group.ravel()[order]) < k])


def _rank_within(sorted_keys: np.ndarray) -> np.ndarray:
    """Position of each element within its run of equal keys."""
    starts = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]
    at = np.arange(len(sorted_keys))
    return at - np.maximum.accumulate(np.where(starts, at, 0))


class _Best:
    """The k best rows per query seen so far in one task: one line of k places per query."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.kth = np.full(queries, np.inf)
        self.used = np.zeros((queries, k), bool)
        self.distance = np.empty((queries, k))
        self.batch = np.empty((queries, k), np.int64)
        self.pos = np.empty((queries, k), np.int64)
        self.ids = np.empty((queries, k), object)

    def add(self, q, distance, batch, pos, ids) -> None:
        """Merge new rows into the lines of their queries; other lines are not looked at."""
        lines = np.unique(q)
        at, place = np.nonzero(self.used[lines])
        held = (lines[at], place)
        q, distance = np.r_[held[0], q], np.r_[self.distance[held], distance]
        batch, pos, ids = np.r_[self.batch[held], batch], np.r_[self.pos[held], pos], np.r_[self.ids[held], ids]
        order = np.lexsort((pos, batch, distance, q))
        rank = _rank_within(q[order])
        keep = order[rank < self.k]
        line = (q[keep], rank[rank < self.k])
        self.used[line] = True
        self.distance[line], self.batch[line], self.pos[line], self.ids[line] = (
            distance[keep],
            batch[keep],
            pos[keep],
            ids[keep],
        )
        full = lines[self.used[lines, -1]]
        last = self.distance[full, -1]
        self.kth[full] = np.where(np.isnan(last), np.inf, last)


def _within(rough: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Flat places of the distances within the bound of their query."""
    if rough.dtype == np.float32:
        bound = np.nextafter(bound.astype(np.float32), np.float32(np.inf))
    with np.errstate(invalid="ignore"):
        # Written as a negation so that undefined distances stay in and rank last.
        return np.flatnonzero(~(rough > bound[:, None]))


def _compare(best: _Best, block: QueryBlock, queries: np.ndarray, x, batch, pos, ids: pa.Array) -> None:
    """Offer the rows of one batch to the given queries."""
    step = max(1, MATRIX_CELLS // max(1, len(x)))
    for at in range(0, len(queries), step):
        chosen = queries[at : at + step]
        q = block.vectors[chosen]
        rough, slack = _rough(x, q, block.space)
        bound = best.kth[chosen]
        near = _within(rough, bound + 2 * slack)
        few = 8 * block.k * len(chosen)
        if len(near) > few and len(x) > block.k:
            # Not enough known yet to tell rows apart: the k-th best of this batch is a bound too.
            here = np.partition(rough, block.k - 1, axis=1)[:, block.k - 1]
            near = _within(rough, np.fmin(bound, here) + 2 * slack)
        mine, rows = np.divmod(near, len(x))
        if len(rows) > few:
            # Many ties: copies of one vector. Those with k equal ones before them drop out.
            offered = np.unique(rows)
            distinct = np.zeros(len(x), bool)
            distinct[offered[_first_copies(x[offered], batch[offered], pos[offered], block.k)]] = True
            mine, rows = mine[distinct[rows]], rows[distinct[rows]]
        if len(rows):
            exact = _exact_in_slices(x, q, rows, mine, block.space)
            # Only the k best per query of this batch go on, so few ids become Python strings.
            order = np.lexsort((pos[rows], batch[rows], exact, mine))
            kept = order[_rank_within(mine[order]) < block.k]
            mine, rows, exact = mine[kept], rows[kept], exact[kept]
            names = np.array(ids.take(pa.array(rows)).to_pylist(), dtype=object)
            best.add(chosen[mine], exact, batch[rows], pos[rows], names)


def _offer(best: _Best, block: QueryBlock, x, batch, pos, ids: pa.Array, cells) -> None:
    """Offer rows to all queries, or where cells matter to those that visit the row's cell."""
    if block.visits is None:
        _compare(best, block, np.arange(len(block.vectors)), x, batch, pos, ids)
        return
    for cell in np.unique(cells):
        queries, here = np.flatnonzero(block.visits[:, cell]), np.flatnonzero(cells == cell)
        if len(queries):
            _compare(best, block, queries, x[here], batch[here], pos[here], ids.take(pa.array(here)))


def _widening(rows: int, step: int) -> Iterator[slice]:
    """Slices of growing size: a few rows bound what a query still has to look at in the many."""
    at, size = 0, min(FIRST_ROWS, step)
    while at < rows:
        yield slice(at, at + size)
        at, size = at + size, min(4 * size, step)


def _shown(best: _Best, block: QueryBlock) -> Iterator[pa.RecordBatch]:
    """The rows held, as result batches."""
    q, place = np.nonzero(best.used)
    for at in range(0, len(q), OUTPUT_ROWS):
        line = (q[at : at + OUTPUT_ROWS], place[at : at + OUTPUT_ROWS])
        yield pa.RecordBatch.from_arrays(
            [
                block.qids.take(pa.array(line[0])),
                pa.array(best.ids[line], pa.string()),
                pa.array(best.distance[line]),
                pa.array(best.batch[line], mask=best.batch[line] == NO_PLACE),
                pa.array(best.pos[line], mask=best.pos[line] == NO_PLACE),
            ],
            names=["qid", "id", "distance", "_batch", "_pos"],
        )


def _kernel(block: QueryBlock) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    dim = block.vectors.shape[1]
    step = max(1, VECTOR_CELLS // dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(block.vectors), block.k)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                batch_no, pos = (rows.column(c).fill_null(NO_PLACE).to_numpy(zero_copy_only=False) for c in ORDER)
                cells = None if block.visits is None else rows.column("_cell").to_numpy(zero_copy_only=False)
                _offer(best, block, _matrix(rows.column("embedding"), dim), batch_no, pos, rows.column("id"), cells)
        yield from _shown(best, block)

    return run


# ------------------------------------------------------------------------ on the driver


def check_k(k: int) -> None:
    if k < 1:
        raise ValidationError("the number of results must be at least 1")


def check_space(space: str) -> None:
    if space not in SPACES:
        raise ValidationError(f"space must be one of {SPACES}, not {space!r}")


def check_vector(vector: Sequence[float], dim: int | None = None) -> np.ndarray:
    """The query vector as float32, as stored vectors are, then widened."""
    v = np.asarray(list(vector), dtype=np.float32).astype(np.float64)
    if v.ndim != 1 or not len(v):
        raise ValidationError("a query vector must not be empty")
    if dim is not None and len(v) != dim:
        raise ValidationError(f"expected a query vector of {dim} components, got {len(v)}")
    return v


def dimension(df: DataFrame) -> int | None:
    """Number of components of the stored vectors, None if there are none. Reads one row."""
    row = df.filter(F.col("embedding").isNotNull()).select(F.size("embedding").alias("n")).first()
    return row["n"] if row else None


def partial_hits(corpus: DataFrame, block: QueryBlock, qid_type: T.DataType) -> DataFrame:
    """The k best rows per query and task."""
    names = ["id", "embedding", *ORDER, *(["_cell"] if block.visits is not None else [])]
    schema = T.StructType([T.StructField("qid", qid_type), *HIT_FIELDS])
    rows = corpus.filter(F.col("embedding").isNotNull()).select(*names)
    return rows.mapInArrow(_kernel(block), schema)


def rank_hits(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits per query with their rank, ties in insertion order.

    Hits of many tasks are cut to k in groups of tasks first, so no task gets all of a query's hits.
    """
    if hits.rdd.getNumPartitions() > MERGED_TASKS:
        grouped = hits.withColumn("_group", F.spark_partition_id() % MERGED_TASKS)
        first = Window.partitionBy("qid", "_group").orderBy("distance", *ORDER)
        hits = grouped.withColumn("_first", F.row_number().over(first)).filter(F.col("_first") <= k).drop("_first", "_group")
    ordered = Window.partitionBy("qid").orderBy("distance", *ORDER)
    return hits.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= k)


def attach(corpus: DataFrame, hits: DataFrame, columns: Sequence[str], small: bool) -> DataFrame:
    """Join the wanted corpus columns to the hits by id. A bounded number of hits is broadcast."""
    wanted = [c for c in columns if c not in ("id", *ORDER)]
    if not wanted:
        return hits
    return corpus.select("id", *wanted).join(F.broadcast(hits) if small else hits, "id")


def nearest_of(
    rows: DataFrame, vector: Sequence[float], k: int, space: str = "l2", dim: int | None = None
) -> DataFrame:
    """Id, distance and position of the k nearest records of one vector."""
    check_k(k)
    check_space(space)
    q = check_vector(vector, dim)
    block = QueryBlock(pa.array([0]), q[None, :], space, k)
    return partial_hits(rows, block, T.LongType()).orderBy("distance", *ORDER).limit(k).drop("qid")


def knn(
    corpus: DataFrame,
    vector: Sequence[float],
    k: int = 10,
    where: Filter = None,
    where_document: Filter = None,
    space: str = "l2",
    include_metadatas: bool = True,
    include_documents: bool = True,
    include_distances: bool = True,
    include_embeddings: bool = False,
    dim: int | None = None,
) -> DataFrame:
    """The k records nearest to one vector, nearest first.

    Filters apply before the search, so k rows come back whenever k rows match.
    """
    rows = apply_filters(corpus, where, where_document)
    hits = nearest_of(rows, vector, k, space, dim)
    shown = included_columns(corpus, include_embeddings, include_metadatas, include_documents)
    result = attach(rows, hits, shown, small=k * HIT_BYTES <= broadcast_limit(corpus.sparkSession))
    if result is not hits:
        result = result.orderBy("distance", *ORDER).limit(k)
    return result.select(*shown, *(["distance"] if include_distances else []))


def collected_hits(hits: DataFrame) -> tuple[Column, DataFrame]:
    """A bounded number of hits, computed now: a filter on their positions, and the hits as local rows."""
    found = hits.collect()
    at: dict[int | None, set[int | None]] = {}
    for r in found:
        at.setdefault(r["_batch"], set()).add(r["_pos"])
    place = F.lit(False)
    # The places only say where to look: the records are joined by id.
    for batch, held in at.items():
        inside = F.col("_batch").isNull() if batch is None else F.col("_batch") == batch
        if None in held:
            place = place | (inside & F.col("_pos").isNull())
        positions = sorted(p for p in held if p is not None)
        # Short lists, because Parquet skips row groups value by value only for short ones.
        for n in range(0, len(positions), PUSHED_VALUES):
            place = place | (inside & F.col("_pos").isin(positions[n : n + PUSHED_VALUES]))
    return place, hits.sparkSession.createDataFrame(found, hits.schema)


def knn_lookup(
    corpus: DataFrame,
    vector: Sequence[float],
    k: int = 10,
    where: Filter = None,
    where_document: Filter = None,
    space: str = "l2",
    include_metadatas: bool = True,
    include_documents: bool = True,
    include_distances: bool = True,
    include_embeddings: bool = False,
    dim: int | None = None,
) -> DataFrame:
    """As :func:`knn`, for few results over stored records: two jobs instead of one.

    The first finds the k hits from vectors alone. The second reads just these records, by a filter
    on their position that lets Parquet skip row groups without a hit.
    """
    found = nearest_of(apply_filters(corpus, where, where_document), vector, k, space, dim)
    shown = included_columns(corpus, include_embeddings, include_metadatas, include_documents)
    place, hits = collected_hits(found)
    result = attach(corpus.filter(place), hits, shown, small=True)
    ordered = result.orderBy("distance", *ORDER).limit(k)
    return ordered.select(*shown, *(["distance"] if include_distances else []))


def _query_blocks(queries: DataFrame, qid: str, embedding: str, dim: int | None) -> tuple[int, int, int]:
    """(queries, components, blocks needed), after checking ids and dimensions."""
    vector = F.col(embedding)
    per_id = queries.groupBy(F.col(qid).alias("qid")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.coalesce(F.size(vector), F.lit(-1))).alias("low"),
        F.max(F.size(vector)).alias("high"),
    )
    s = per_id.agg(
        F.count(F.lit(1)).alias("queries"),
        F.max("n").alias("copies"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.count_if(F.col("qid").isNull()).alias("unnamed"),
    ).first()
    if not s["queries"]:
        return 0, 0, 0
    if s["copies"] > 1 or s["unnamed"]:
        raise ValidationError("query ids must be unique and not null")
    if s["low"] < 1 or s["low"] != s["high"] or (dim is not None and s["low"] != dim):
        raise ValidationError(f"query vectors must all have the same dimension, {dim or 'at least 1'}")
    size = s["queries"] * (s["low"] * 8 + 64)
    limit = broadcast_limit(queries.sparkSession)
    # Blocks are cut by hash; a quarter of slack keeps an uneven one within the bound.
    return s["queries"], s["low"], 1 if size <= limit else -(-size * 5 // (limit * 4))


def knn_join(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 10,
    where: Filter = None,
    where_document: Filter = None,
    space: str = "l2",
    qid: str = "qid",
    embedding: str = "embedding",
    include_metadatas: bool = True,
    include_documents: bool = True,
    include_embeddings: bool = False,
    dim: int | None = None,
    lookup: int = 0,
) -> DataFrame:
    """The k nearest records of every query vector: columns qid, rank, distance and the record.

    The query side is measured. Up to the broadcast bound it is one block that travels with the tasks; beyond
    it, blocks of queries are dealt to shards of the corpus by a shuffle. Query ids must be unique. If there can be no more than `lookup` hits, they are found first and their records
    then read by position, as in :func:`knn_lookup`.
    """
    check_k(k)
    check_space(space)
    shown = included_columns(corpus, include_embeddings, include_metadatas, include_documents)
    rows = apply_filters(corpus, where, where_document)
    hits, total = hits_of_queries(rows, queries, k, space, qid, embedding, dim)
    small = total * HIT_BYTES <= broadcast_limit(corpus.sparkSession)
    if 0 < total <= lookup:
        place, hits = collected_hits(hits)
        rows = corpus.filter(place)
    return attach(rows, hits, shown, small).select("qid", "rank", *shown, "distance")


def hits_of_queries(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    space: str,
    qid: str,
    embedding: str,
    dim: int | None = None,
    visits: Callable[[np.ndarray, pa.Table], np.ndarray] | None = None,
    extra: Sequence[str] = (),
) -> tuple[DataFrame, int]:
    """Ranked hits of all queries, and how many there can be.

    `visits`, if given, tells for a block of queries (vectors, and a table with the `extra` columns)
    which cells each may visit.
    """
    queries = queries.select(F.col(qid).alias("qid"), F.col(embedding).cast("array<float>").alias("v"), *extra)
    qid_type = queries.schema["qid"].dataType
    total, columns, blocks = _query_blocks(queries, "qid", "v", dim)
    if blocks == 1 and total > TASK_PAIRS // (SHARD_CELLS // columns or 1):
        # Few splits of the corpus may hold many records: then the pairs are dealt out.
        blocks = 1 + (total * rows.filter(F.col("embedding").isNotNull()).count() > TASK_PAIRS)

    if blocks == 0:
        nothing = QueryBlock(pa.array([], pa.int64()), np.empty((0, 1)), space, k)
        return rank_hits(partial_hits(rows.filter(F.lit(False)), nothing, qid_type), k), 0
    if blocks > 1:
        return rank_hits(_hits_by_shards(rows, queries, k, space, columns, visits, extra), k), total * k
    table = queries.toArrow().combine_chunks()
    vectors = _matrix(table.column("v").combine_chunks(), columns)
    mask = visits(vectors, table) if visits else None
    block = QueryBlock(table.column("qid").combine_chunks(), vectors, space, k, mask)
    visited = rows if mask is None else rows.filter(F.col("_cell").isin(np.flatnonzero(mask.any(axis=0)).tolist()))
    return rank_hits(partial_hits(visited, block, qid_type), k), total * k


def _hits_by_shards(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    space: str,
    dim: int,
    visits: Callable[[np.ndarray, pa.Table], np.ndarray] | None,
    extra: Sequence[str],
) -> DataFrame:
    """The k best rows of every query in every shard of the corpus, for a query side of any size.

    The corpus is cut into shards and the queries into blocks, so that a shard and a block make at most about
    `TASK_PAIRS` pairs; each shard meets each block in a task of its own. More rows make more tasks, not longer ones.
    One job, and nothing passes through the driver. Rows travel packed; the shuffle carries the corpus once per
    block and the queries once per shard, little beside the products that each copy stands for.
    """
    spark = rows.sparkSession
    held = rows.filter(F.col("embedding").isNotNull())
    limit = broadcast_limit(spark)
    most = max(1, min(SHARD_CELLS // dim, limit // (8 * dim + 64)))
    shards = max(1, -(-held.count() // most))
    blocks = max(1, -(-queries.count() // max(1, min(TASK_PAIRS // most, limit // (8 * dim + 64)))))
    per_block = max(1, min(VECTOR_CELLS // dim, limit // (8 * dim + 64)))
    with_cell = visits is not None
    qid_type = queries.schema["qid"].dataType
    packed = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("is_query", T.BooleanType()),
            T.StructField("vectors", T.ArrayType(T.FloatType())),
            T.StructField("ids", T.ArrayType(T.StringType())),
            T.StructField("batches", T.ArrayType(T.LongType())),
            T.StructField("places", T.ArrayType(T.LongType())),
            T.StructField("cells", T.ArrayType(T.IntegerType())),
            T.StructField("qids", T.ArrayType(qid_type)),
            *[T.StructField(f"x_{n}", T.ArrayType(queries.schema[n].dataType)) for n in extra],
        ]
    )

    def one_list(values: pa.Array, kind: pa.DataType | None = None) -> pa.Array:
        values = values if kind is None else values.cast(kind)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def pack(is_query: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = to_arrow_schema(packed)
            for batch in batches:
                for at in range(0, batch.num_rows, per_block):
                    part = batch.slice(at, per_block)
                    numbers = part.column("shard").to_numpy(zero_copy_only=False)
                    for shard in np.unique(numbers):
                        own = part.filter(pa.array(numbers == shard))
                        _matrix(own.column("v"), dim)  # all of one length
                        lists = {"vectors": one_list(own.column("v").flatten(), pa.float32())}
                        if is_query:
                            lists["qids"] = one_list(own.column("qid"))
                            lists.update({f"x_{n}": one_list(own.column(n)) for n in extra})
                        else:
                            lists |= {"ids": one_list(own.column("id")), "batches": one_list(own.column("_batch")), "places": one_list(own.column("_pos"))}
                            if with_cell:
                                lists["cells"] = one_list(own.column("_cell"), pa.int32())
                        lists |= {"shard": pa.array([shard], pa.int32()), "is_query": pa.array([is_query])}
                        columns = [lists[f.name].cast(f.type) if f.name in lists else pa.nulls(1, f.type) for f in schema]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

        return run

    corpus = held.select(
        F.pmod(F.xxhash64("id", *ORDER), F.lit(shards)).cast("int").alias("shard"),
        F.col("embedding").cast("array<float>").alias("v"),
        "id",
        *ORDER,
        *(["_cell"] if with_cell else []),
    ).mapInArrow(pack(False), packed)
    asked = queries.select(F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("shard"), "v", "qid", *extra).mapInArrow(pack(True), packed)
    # Rows are packed once and then copied: a shard's for every block, a block's for every shard.
    corpus = corpus.withColumn("shard", F.explode(F.sequence(F.col("shard") * blocks, F.col("shard") * blocks + blocks - 1)))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.col("shard"), F.col("shard") + (shards - 1) * blocks, F.lit(blocks))))
    dealt = corpus.unionByName(asked).repartitionById(shards * blocks, "shard").sortWithinPartitions("shard", "is_query")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, whole, step = None, [], False, max(1, VECTOR_CELLS // dim)
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                if shard is None or row.column("shard")[0].as_py() != shard:
                    shard, parts, whole = row.column("shard")[0].as_py(), [], False
                flat = row.column("vectors").flatten()
                x = _matrix(pa.FixedSizeListArray.from_arrays(flat, dim), dim)
                if not row.column("is_query")[0].as_py():
                    batch_no, pos = (row.column(c).flatten().fill_null(NO_PLACE).to_numpy(zero_copy_only=False) for c in ("batches", "places"))
                    cells = row.column("cells").flatten().to_numpy(zero_copy_only=False) if with_cell else None
                    parts.append((x.astype(np.float32), batch_no, pos, row.column("ids").flatten(), cells))
                    continue
                if not whole and parts:  # blocks arrive cut small where there are many shards
                    x32, *numbers = (np.concatenate(c) if c[0] is not None else None for c in zip(*((p[0], p[1], p[2], p[4]) for p in parts)))
                    once = _first_copies(x32, numbers[0], numbers[1], k)
                    own = None if numbers[2] is None else numbers[2][once]
                    parts = [(x32[once], numbers[0][once], numbers[1][once], pa.concat_arrays([p[3] for p in parts]).take(pa.array(once)), own)]
                    whole = True
                table = pa.table({name: row.column(f"x_{name}").flatten() for name in extra})
                block = QueryBlock(row.column("qids").flatten(), x, space, k, visits(x, table) if with_cell else None)
                best = _Best(len(x), k)
                for vectors, batch_no, pos, ids, cells in parts:
                    for some in _widening(len(vectors), step):
                        own = None if cells is None else cells[some]
                        _offer(best, block, vectors[some].astype(np.float64), batch_no[some], pos[some], ids[some], own)
                yield from _shown(best, block)

    schema = T.StructType([T.StructField("qid", qid_type), *HIT_FIELDS])
    return dealt.mapInArrow(compare, schema)


def ensure_checkpoint_dir(df: DataFrame, fallback: str | None = None) -> None:
    """Checkpoints go to the folder the cluster names; `fallback`, also shared, serves if it names none.

    Without either, a session on one machine gets a temporary folder and a cluster an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
        if not folder and context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="kinfold-checkpoints-")
        if not folder:
            raise ValidationError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(folder)


def embed_text(df: DataFrame, text: str, embedder: Embedder | None) -> list[float]:
    """One text as a vector."""
    if embedder is None:
        raise ValidationError("cannot query by text without an embedding function")
    spark = df.sparkSession
    given = spark.createDataFrame([(text,)], "text string")
    return given.select(embedder.embed(F.col("text")).alias("v")).first()["v"]


def knn_text(corpus: DataFrame, text: str, embedder: Embedder | None, k: int = 10, **options: Any) -> DataFrame:
    """The k records nearest to a text."""
    return knn(corpus, embed_text(corpus, text, embedder), k, **options)


def knn_join_text(
    corpus: DataFrame, queries: DataFrame, embedder: Embedder, k: int = 10, text: str = "text", **options: Any
) -> DataFrame:
    """The k nearest records of every query text."""
    ensure_checkpoint_dir(corpus)
    # The query side is read more than once; each text is embedded once.
    vectors = queries.withColumn("embedding", embedder.embed(F.col(text))).checkpoint()
    return knn_join(corpus, vectors, k, embedding="embedding", **options)


def search(
    corpus: DataFrame, text: str, embedder: Embedder | None, limit: int = 10, filter: Filter = None, space: str = "l2"
) -> DataFrame:
    """Semantic search with an optional metadata filter."""
    return knn_text(corpus, text, embedder, limit, where=filter, space=space)


def search_equals(
    corpus: DataFrame,
    text: str,
    embedder: Embedder | None,
    field: str,
    value: object,
    limit: int = 10,
    space: str = "l2",
) -> DataFrame:
    """Semantic search over the records whose field has one value."""
    return search(corpus, text, embedder, limit, Where().equals(field, value), space)
