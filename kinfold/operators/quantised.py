"""Approximate search over cells with residual product quantisation and an exact rerank.

A stored vector is its cell's centroid plus a residual. The residual is cut into parts of a few components, and each
part is replaced by the nearest of at most 256 codewords, so a vector takes one byte per part. For a
query, one table per part holds its products with all codewords; the approximate distance to a row is

    |q - c|^2 - 2 (sum of table entries) + fixed(row),   fixed(row) = |r|^2 + 2 c.r for the decoded residual r

with the first term per query and cell, the last per row and stored with the code. The best `depth` rows
of every query are then measured exactly on the stored vectors.

How many cells a query visits depends on the query: all whose centroid lies within a factor of its nearest centroid's
distance. The factor and the depth come from queries with known answers: they are the smallest that find
the wanted share of true neighbours, with a margin for the size of that sample.

Training takes bounded samples (`TRAINING_ROWS`, `TUNING_QUERIES`); every row is encoded and can be found.
Squared L2 only. Vectors are taken as they are; records without one take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinfold.errors import ValidationError
from kinfold.functions.distance import squared_l2
from kinfold.operators.approximate import Cells
from kinfold.operators.search import (
    FIRST_ROWS,
    HIT_BYTES,
    OUTPUT_ROWS,
    TASK_PAIRS,
    _rank_within,
    _widening,
    ensure_checkpoint_dir,
    knn_join,
    rank_hits,
)
from kinfold.plans.sizing import broadcast_limit, fits
from kinfold.schema import ORDER

#: Rows that codewords are trained on, and queries that the effort is tuned on, whatever the size of the table.
TRAINING_ROWS = 20_000
TUNING_QUERIES = 400
#: Cells of one table of approximate distances inside a task.
TABLE_CELLS = 4_000_000
#: Codes that one task holds, and queries that it takes at once, where many queries meet many codes.
SHARD_ROWS = 1 << 20
BLOCK_QUERIES = 1 << 14
#: Codes decoded at once, and queries that they are compared with in one matrix product.
DECODED_ROWS = 1 << 14
PRODUCT_QUERIES = 256
#: Standard errors by which the tuning sample's recall must pass the target.
MARGIN = 2.0


@dataclass(frozen=True)
class Quantiser:
    cells: Cells
    codewords: np.ndarray  # part, codeword, component

    @property
    def parts(self) -> int:
        return len(self.codewords)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes (a byte per part) and fixed term of each row."""
        home = self.cells.nearest(x, 1)[:, 0]
        center = self.cells.centroids[home]
        residual = (x - center).reshape(len(x), self.parts, -1)
        codes = np.empty((len(x), self.parts), np.uint8)
        decoded = np.empty_like(residual)
        for p, words in enumerate(self.codewords):
            codes[:, p] = _nearest_words(residual[:, p], words)
            decoded[:, p] = words[codes[:, p]]
        decoded = decoded.reshape(x.shape)
        return home, codes, np.square(decoded).sum(axis=1) + 2.0 * (center * decoded).sum(axis=1)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Products of each query with all codewords: query, part, codeword."""
        return np.einsum("qpd,pwd->qpw", q.reshape(len(q), self.parts, -1), self.codewords)

    def gaps(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of each query to each centroid."""
        c = self.cells.centroids
        return np.maximum(np.square(q).sum(axis=1)[:, None] + np.square(c).sum(axis=1)[None, :] - 2.0 * (q @ c.T), 0.0)


@dataclass(frozen=True)
class Effort:
    """Visit cells up to `factor` times the nearest centroid's squared distance; measure `depth` rows exactly."""

    factor: float
    depth: int


def _visits(gaps: np.ndarray, effort: Effort) -> np.ndarray:
    """Which cells (columns) each query (row) visits."""
    return gaps <= (np.inf if np.isinf(effort.factor) else effort.factor * gaps.min(axis=1, keepdims=True) + 1e-12)


def _nearest_words(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (np.square(words).sum(axis=1)[None, :] - 2.0 * (x @ words.T)).argmin(axis=1)


def _vectors(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _bounded(df: DataFrame, key: str, most: int, seed: int, *columns: str) -> pa.Table:
    """At most `most` rows, those with the smallest hash of the key."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(most).select(*columns).toArrow()


def train_quantiser(df: DataFrame, cells: Cells, *, parts: int = 16, words: int = 256, seed: int = 5, rounds: int = 12) -> Quantiser:
    """Codewords by k-means of each part of the residuals, on at most `TRAINING_ROWS` rows."""
    dim = cells.centroids.shape[1]
    if dim % parts or not 1 <= words <= 256:
        raise ValidationError(f"{parts} parts must divide {dim} components, with at most 256 codewords")
    rows = _bounded(df.filter(F.col("embedding").isNotNull()), "id", TRAINING_ROWS, seed, "embedding")
    x = _vectors(rows.column("embedding"), dim)
    residual = (x - cells.centroids[cells.nearest(x, 1)[:, 0]]).reshape(len(x), parts, -1) if len(x) else np.zeros((1, parts, dim // parts))
    draw = np.random.default_rng(seed)
    codewords = np.zeros((parts, min(words, len(residual)), dim // parts))
    for p in range(parts):
        part = residual[:, p]
        book = part[draw.choice(len(part), codewords.shape[1], replace=False)]
        for _ in range(rounds):
            near = _nearest_words(part, book)
            n = np.bincount(near, minlength=len(book))
            for d in range(book.shape[1]):
                mean = np.bincount(near, part[:, d], len(book)) / np.maximum(n, 1)
                book[:, d] = np.where(n > 0, mean, book[:, d])
        codewords[p] = book
    return Quantiser(cells, codewords)


def encode(df: DataFrame, quantiser: Quantiser) -> DataFrame:
    """id, order, cell, codes and fixed term of every record with a vector: the index that searches read."""
    dim = quantiser.cells.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                home, codes, fixed = quantiser.encode(_vectors(part.column("embedding"), dim))
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                columns = [*(part.column(c) for c in ("id", *ORDER)), pa.array(home.astype(np.int32)), packed, pa.array(fixed)]
                yield pa.RecordBatch.from_arrays(columns, ["id", *ORDER, "_cell", "_codes", "_fixed"])

    rows = df.filter(F.col("embedding").isNotNull()).select("id", *ORDER, "embedding")
    return rows.mapInArrow(run, "id string, _batch bigint, _pos bigint, _cell int, _codes binary, _fixed double")


def _candidates(index: DataFrame, quantiser: Quantiser, table: pa.Table, qid_type, effort: Effort) -> DataFrame:
    """Per query and task the `depth` rows with the smallest approximate distances in the visited cells."""
    dim = quantiser.cells.centroids.shape[1]
    qids, q = table.column("qid").combine_chunks(), _vectors(table.column("v"), dim)
    gaps = quantiser.gaps(q)
    visits = _visits(gaps, effort)
    parts, depth = quantiser.parts, effort.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = quantiser.tables(q)
        kept: list[tuple[np.ndarray, list, list, list]] = [(np.zeros(0), [], [], []) for _ in range(len(q))]
        waiting: list[pa.RecordBatch] = []

        def offer(rows: pa.Table) -> None:
            codes = np.frombuffer(b"".join(rows.column("_codes").to_pylist()), np.uint8).reshape(-1, parts)
            fixed, cells = rows.column("_fixed").to_numpy(), rows.column("_cell").to_numpy()
            names, batch_no, pos = (rows.column(c).to_pylist() for c in ("id", *ORDER))
            for cell in np.unique(cells):
                here = np.flatnonzero(cells == cell)
                asking = np.flatnonzero(visits[:, cell])
                step = max(1, TABLE_CELLS // max(1, len(here)))
                for at in range(0, len(asking), step):
                    who = asking[at : at + step]
                    near = np.zeros((len(who), len(here)))
                    for p in range(parts):
                        near += tables[who, p][:, codes[here, p]]
                    near = gaps[who, cell][:, None] - 2.0 * near + fixed[here][None, :]
                    for line, k in zip(near, who):
                        held, *known = kept[k]
                        few = np.argpartition(line, depth)[:depth] if len(line) > depth else np.arange(len(line))
                        if len(held) >= depth:
                            few = few[line[few] < held[-1]]
                            if not len(few):
                                continue
                        merged = np.concatenate([held, line[few]])
                        order = np.argsort(merged, kind="stable")[:depth]
                        rows_here = here[few]
                        lists = [old + [new[r] for r in rows_here] for old, new in zip(known, (names, batch_no, pos))]
                        kept[k] = (merged[order], *([x[o] for o in order] for x in lists))

        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= 50_000:
                offer(pa.Table.from_batches(waiting))
                waiting, rows = [], 0
        if rows:
            offer(pa.Table.from_batches(waiting))
        for k, (distance, names, batch_no, pos) in enumerate(kept):
            if len(names):
                yield pa.RecordBatch.from_arrays(
                    [qids.take(pa.array([k] * len(names))), pa.array(names, pa.string()), pa.array(distance), pa.array(batch_no, pa.int64()), pa.array(pos, pa.int64())],
                    ["qid", "id", "distance", "_batch", "_pos"],
                )

    visited = index.filter(F.col("_cell").isin(np.flatnonzero(visits.any(axis=0)).tolist()))
    return visited.mapInArrow(run, f"qid {qid_type.simpleString()}, id string, distance double, _batch bigint, _pos bigint")


class _Nearest:
    """The `depth` rows of one shard of codes with the smallest approximate distances to each query of a block."""

    def __init__(self, quantiser: Quantiser, q: np.ndarray, effort: Effort):
        self.quantiser, self.q, self.depth = quantiser, q, effort.depth
        self.gaps = quantiser.gaps(q)
        self.visits = _visits(self.gaps, effort)
        self.distance = np.full((len(q), effort.depth), np.inf)
        self.row = np.full((len(q), effort.depth), -1)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.number = 0
        reach = max(self.gaps.max(initial=0.0), np.square(quantiser.codewords).sum(axis=2).max(axis=1).sum())
        self.kind = np.float32 if reach < 1e30 else np.float64

    def offer(self, cell: int, codes: np.ndarray, rows: np.ndarray) -> None:
        """Compare codes of one cell with the queries that visit it: by products of decoded residuals, which
        for many queries take less than a table entry for every part and pair. Rows come in ascending order."""
        asking = np.flatnonzero(self.visits[:, cell])
        if not len(asking):
            return
        residual = np.concatenate([words[codes[:, p]] for p, words in enumerate(self.quantiser.codewords)], axis=1)
        right = np.column_stack([residual, np.square(residual).sum(axis=1), np.ones(len(rows))]).astype(self.kind).T
        few = False
        for at in range(0, len(asking), PRODUCT_QUERIES):
            who = asking[at : at + PRODUCT_QUERIES]
            left = np.column_stack([-2.0 * (self.q[who] - self.quantiser.cells.centroids[cell]), np.ones(len(who)), self.gaps[who, cell]])
            near = left.astype(self.kind) @ right
            last = self.distance[who, -1]
            few |= bool(np.isinf(last).any())
            if len(rows) > self.depth and np.isinf(last).any():
                # Not enough known yet to tell rows apart: the last of the best of these rows is a bound too.
                here = np.partition(near, self.depth - 1, axis=1)[:, self.depth - 1]
                place = np.flatnonzero(np.where(np.isinf(last), near.T <= here, near.T < last.astype(self.kind)).T)
            else:
                place = np.flatnonzero(near < last.astype(self.kind)[:, None])
            if len(place):
                query, found = np.divmod(place, len(rows))
                self.waiting.append((who[query], near.ravel()[place].astype(np.float64), rows[found]))
                self.number += len(place)
        # Most rows are far, so it pays to sort what is near only now and then.
        if few or self.number > self.depth * len(self.q):
            self.settle()

    def settle(self) -> None:
        """Merge the waiting rows into the lines of their queries; ties stay in order of the rows."""
        if not self.waiting:
            return
        query, distance, row = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.number = [], 0
        lines = np.unique(query)
        query = np.concatenate([np.repeat(lines, self.depth), query])
        distance = np.concatenate([self.distance[lines].ravel(), distance])
        row = np.concatenate([self.row[lines].ravel(), row])
        order = np.lexsort((distance, query))
        rank = _rank_within(query[order])
        keep = order[rank < self.depth]
        at = (query[keep], rank[rank < self.depth])
        self.distance[at], self.row[at] = distance[keep], row[keep]


def _candidates_by_shards(index: DataFrame, quantiser: Quantiser, asked: DataFrame, number: int, effort: Effort) -> DataFrame:
    """As :func:`_candidates`, ranked, for a query side of any size: one job, and nothing passes through the driver.

    The codes are cut into shards and the queries into blocks, so that both fit in a task and make at most about
    `TASK_PAIRS` pairs; each block meets each shard in a task of its own. More rows make more tasks, not longer ones.
    What the shuffle copies is codes, a few bytes a row, so that a shard holds many rows and few hits leave a task.
    """
    spark, dim, parts, depth = index.sparkSession, quantiser.cells.centroids.shape[1], quantiser.parts, effort.depth
    qid_type, limit = asked.schema["qid"].dataType, broadcast_limit(index.sparkSession)
    rows = index.count()
    most = max(1, min(SHARD_ROWS, limit // (parts + 48)))
    shards = max(1, -(-rows // most))
    per_task = max(1, min(BLOCK_QUERIES, TASK_PAIRS // max(1, min(most, rows)), limit // (16 * dim + 16 * depth)))
    # Few pairs are spread over the cores all the same, down to some hundreds of queries in a task.
    wanted = min(-(-number // PRODUCT_QUERIES), 2 * spark.sparkContext.defaultParallelism)
    blocks = max(1, -(-number // per_task), -(-wanted // shards))
    fields = [("vectors", T.FloatType()), ("qids", qid_type), ("codes", T.BinaryType()), ("cells", T.IntegerType())]
    fields += [("ids", T.StringType()), ("batches", T.LongType()), ("places", T.LongType())]
    packed = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("is_query", T.BooleanType())])
    for name, kind in fields:
        packed = packed.add(name, T.ArrayType(kind))

    def pack(is_query: bool, per_row: int, sources: dict[str, str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = to_arrow_schema(packed)
            for batch in batches:
                for at in range(0, batch.num_rows, per_row):
                    part = batch.slice(at, per_row)
                    tasks = part.column("task").to_numpy(zero_copy_only=False)
                    for task in np.unique(tasks):
                        own = part.filter(pa.array(tasks == task))
                        held = {"task": pa.array([task], pa.int32()), "is_query": pa.array([is_query])}
                        for name, source in sources.items():
                            values = own.column(source)
                            values = values.flatten() if name == "vectors" else values
                            held[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                        columns = [held[f.name].cast(f.type) if f.name in held else pa.nulls(1, f.type) for f in schema]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

        return run

    of_rows = {"codes": "_codes", "cells": "_cell", "ids": "id", "batches": "_batch", "places": "_pos"}
    coded = index.withColumn("task", F.pmod(F.xxhash64("id", *ORDER), F.lit(shards)).cast("int"))
    coded = coded.select("task", *of_rows.values()).mapInArrow(pack(False, DECODED_ROWS, of_rows), packed)
    some = asked.select(F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("task"), "qid", "v")
    some = some.mapInArrow(pack(True, DECODED_ROWS, {"vectors": "v", "qids": "qid"}), packed)
    # Rows are packed once and then copied: a shard's for every block, a block's for every shard.
    coded = coded.withColumn("task", F.explode(F.sequence(F.col("task") * blocks, F.col("task") * blocks + blocks - 1)))
    some = some.withColumn("task", F.explode(F.sequence(F.col("task"), F.col("task") + (shards - 1) * blocks, F.lit(blocks))))
    dealt = coded.unionByName(some).repartitionById(shards * blocks, "task").sortWithinPartitions("task", "is_query")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(coded: list[pa.RecordBatch], some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not coded or not some:
                return
            cells, batch_no, pos = (pa.concat_arrays([b.column(c).flatten() for b in coded]) for c in ("cells", "batches", "places"))
            codes = np.frombuffer(b"".join(x for b in coded for x in b.column("codes").flatten().to_pylist()), np.uint8).reshape(-1, parts)
            ids = pa.concat_arrays([b.column("ids").flatten() for b in coded])
            numbers = [c.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False) for c in (pos, batch_no)]
            home = cells.to_numpy(zero_copy_only=False)
            order = np.lexsort((*numbers, home))  # one cell after another, ties in insertion order
            qids = pa.concat_arrays([b.column("qids").flatten() for b in some])
            q = pa.concat_arrays([b.column("vectors").flatten() for b in some]).to_numpy(zero_copy_only=False)
            near = _Nearest(quantiser, q.astype(np.float64).reshape(-1, dim), effort)
            edges = np.searchsorted(home[order], np.arange(quantiser.cells.count + 1))
            for cell in range(quantiser.cells.count):
                own = np.arange(edges[cell], edges[cell + 1])
                for step in _widening(len(own), max(FIRST_ROWS, DECODED_ROWS)):
                    near.offer(cell, codes[order[own[step]]], own[step])
            near.settle()
            query, place = np.nonzero(near.row >= 0)
            for at in range(0, len(query), OUTPUT_ROWS):
                line = (query[at : at + OUTPUT_ROWS], place[at : at + OUTPUT_ROWS])
                taken = pa.array(order[near.row[line]])
                columns = [qids.take(pa.array(line[0])), ids.take(taken), pa.array(near.distance[line]), batch_no.take(taken), pos.take(taken)]
                yield pa.RecordBatch.from_arrays(columns, ["qid", "id", "distance", "_batch", "_pos"])

        task, coded, some = None, [], []
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                if row.column("task")[0].as_py() != task:
                    yield from found(coded, some)
                    task, coded, some = row.column("task")[0].as_py(), [], []
                (some if row.column("is_query")[0].as_py() else coded).append(row)
        yield from found(coded, some)

    hits = dealt.mapInArrow(compare, f"qid {qid_type.simpleString()}, id string, distance double, _batch bigint, _pos bigint")
    return rank_hits(hits, depth) if shards > 1 else hits


def search(
    corpus: DataFrame, index: DataFrame, quantiser: Quantiser, effort: Effort, queries: DataFrame, k: int = 10, qid: str = "qid", embedding: str = "embedding"
) -> DataFrame:
    """qid, rank, id, distance: the k nearest of every query among its candidates, measured exactly.

    Query ids must be unique. Beyond the broadcast bound blocks of queries are dealt to shards of the codes by a shuffle.
    """
    ensure_checkpoint_dir(corpus)
    spark, dim = corpus.sparkSession, quantiser.cells.centroids.shape[1]
    asked = queries.select(F.col(qid).alias("qid"), F.col(embedding).cast("array<float>").alias("v"))
    qid_type = asked.schema["qid"].dataType
    effort = replace(effort, depth=max(effort.depth, k))
    number = asked.count()
    size = number * (8 * dim + 8 * quantiser.codewords.shape[1] * quantiser.parts + HIT_BYTES * effort.depth)
    if size <= broadcast_limit(spark):
        hits = rank_hits(_candidates(index, quantiser, asked.toArrow(), qid_type, effort), effort.depth)
    else:
        hits = _candidates_by_shards(index, quantiser, asked, number, effort)
    found = hits.select("qid", "id").checkpoint()
    small = number * effort.depth * HIT_BYTES <= broadcast_limit(spark)
    held = corpus.select("id", *ORDER, F.col("embedding").alias("_x")).join(F.broadcast(found) if small else found, "id")
    held = held.join(F.broadcast(asked) if fits(asked) else asked, "qid")
    exact = held.select("qid", "id", *ORDER, squared_l2(F.col("v"), F.col("_x")).alias("distance"))
    return rank_hits(exact, k).select("qid", "rank", "id", "distance")


def tune(
    corpus: DataFrame, quantiser: Quantiser, index: DataFrame, queries: DataFrame, *, k: int = 10, target: float = 0.9, seed: int = 9, qid: str = "qid"
) -> Effort:
    """The least effort that finds the `target` share of the true k nearest, measured on at most `TUNING_QUERIES` queries.

    First the depth at which approximate ranks hold the true neighbours with all cells visited, then the factor.
    """
    ensure_checkpoint_dir(corpus)
    dim = quantiser.cells.centroids.shape[1]
    some = queries.select(F.col(qid).alias("qid"), F.col("embedding").cast("array<float>").alias("embedding"))
    some = some.orderBy(F.xxhash64("qid", F.lit(seed)), "qid").limit(TUNING_QUERIES).checkpoint()
    truth = knn_join(corpus, some, k, include_metadatas=False, include_documents=False).select("qid", "id").checkpoint()
    # The most a query may ever have to measure: enough for any code that tells rows apart at all.
    depth = 32 * k
    table = some.select("qid", F.col("embedding").alias("v")).toArrow()
    if not table.num_rows:
        return Effort(1.0, k)
    hits = rank_hits(_candidates(index, quantiser, table, some.schema["qid"].dataType, Effort(np.inf, depth)), depth)
    seen = truth.join(hits.select("qid", "id", "rank"), ["qid", "id"], "left").join(index.select("id", "_cell"), "id")
    rows = seen.select("qid", F.coalesce("rank", F.lit(depth + 1)).alias("rank"), "_cell").toArrow()  # k rows per tuning query
    rank, cell = rows.column("rank").to_numpy(), rows.column("_cell").to_numpy()
    gaps = quantiser.gaps(_vectors(table.column("v"), dim))
    line = {x: n for n, x in enumerate(table.column("qid").to_pylist())}
    who = np.array([line[x] for x in rows.column("qid").to_pylist()])
    ratio = gaps[who, cell] / np.maximum(gaps[who].min(axis=1), 1e-300)
    # Half of what may be missed is left to either choice.
    wanted = min(1.0, target + MARGIN * np.sqrt(target * (1 - target) / max(1, len(rank))))
    each = 1.0 - (1.0 - wanted) / 2
    deep = int(np.quantile(rank, each, method="higher")) if len(rank) else k
    factor = float(np.quantile(ratio, each, method="higher")) if len(rank) else 1.0
    return Effort(factor * (1 + 1e-9), max(k, deep))
