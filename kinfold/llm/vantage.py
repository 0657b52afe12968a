"""Nearest neighbours by inner product with a vantage-point tree in every shard.

Vectors get one more component so that all have the largest length; then the nearest by Euclidean
distance are those with the largest inner product. Shards are dealt by a hash of the id and have a
bounded size whatever the table. A task builds the tree of a shard and sends blocks of queries through
it: each inner node has a vantage point and halves the others by their distance to it, and the triangle
inequality rules halves out. `factor` relaxes the rule: above 1 more is skipped, at 1 the search is exact.
What a shard finds is scored in double precision, component by component, and the best of all shards are
merged, first in groups of shards.

Vectors that are null, empty, all zero, or hold null or non-finite components take no part, nor do rows
without id, nor vectors of another length than the most common. Rows with the query's id are its own.
Equal scores go to the smaller id. Too few candidates, or none, give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = 256
#: Vectors of a shard, about, and queries of a block.
SHARD_ROWS = 16_384
BLOCK_ROWS = 512
#: Slack for rounding where distances decide whether a half is skipped.
SLACK = 1e-9


class Tree:
    """A vantage-point tree over points (with the added component); ids and vectors in the tree's order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float):
        extra = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
        self.points, self.ids, self.vectors = np.column_stack([vectors, extra]), ids, vectors
        self.order, self.longest = np.argsort(ids, kind="stable"), longest
        self.nodes: list[tuple] = []
        self.draw = np.random.default_rng(1)
        self.root = self._grow(np.arange(len(ids)))

    def _grow(self, rows: np.ndarray) -> int:
        place = len(self.nodes)
        if len(rows) <= LEAF:
            self.nodes.append((None, rows))
            return place
        self.nodes.append(())
        k = int(self.draw.integers(len(rows)))
        point, rest = rows[k], np.delete(rows, k)
        apart = np.sqrt(((self.points[rest] - self.points[point]) ** 2).sum(1))
        near = np.argsort(apart, kind="stable")
        half = len(rest) // 2
        inner, outer = rest[near[:half]], rest[near[half:]]
        bounds = apart[near[half - 1]], apart[near[half]]
        self.nodes[place] = (point, bounds, self._grow(inner), self._grow(outer))
        return place


class Search:
    """The best `k` of a tree for a block of queries."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.tree, self.own, self.queries, self.k, self.factor = tree, ids, queries, k, factor
        self.reach = (queries**2).sum(1) + tree.longest**2
        n = len(ids)
        self.scores, self.found = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        self._visit(tree.root, np.arange(n))

    def _radius(self, which: np.ndarray) -> np.ndarray:
        """Distance within which something better may lie."""
        return np.sqrt(np.maximum(self.reach[which] - 2 * self.scores[which, -1], 0)) + SLACK

    def _offer(self, which: np.ndarray, rows: np.ndarray) -> None:
        """Put rows of the tree to the queries: a product tells which may be among the best, exact scores which are."""
        rough = self.queries[which] @ self.tree.vectors[rows].T
        floor = self.scores[which, -1]
        if len(rows) > self.k:
            floor = np.maximum(floor, -np.partition(-rough, self.k, axis=1)[:, self.k])  # one may be the query's own
        size = np.abs(rough).max(initial=0) + self.tree.longest**2
        q, r = np.nonzero(rough >= (floor - 1e-12 * size)[:, None])
        ids = self.tree.ids[rows[r]]
        other = ids != self.own[which[q]]
        q, r, ids = q[other], r[other], ids[other]
        exact = np.zeros(len(q))
        for d in range(self.queries.shape[1]):
            exact += self.queries[which[q], d] * self.tree.vectors[rows[r], d]
        # Old and new together, best first.
        query = np.concatenate([np.repeat(np.arange(len(which)), self.k), q])
        score = np.concatenate([self.scores[which].ravel(), exact])
        ids = np.concatenate([self.found[which].ravel(), ids])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, "left")
        keep = rank < self.k
        self.scores[which], self.found[which] = score[keep].reshape(-1, self.k), ids[keep].reshape(-1, self.k)

    def _visit(self, node: int, which: np.ndarray) -> None:
        if not len(which):
            return
        point, *rest = self.tree.nodes[node]
        if point is None:
            self._offer(which, rest[0])
            return
        (most_in, least_out), inner, outer = rest
        self._offer(which, np.array([point]))
        q = self.queries[which]
        apart = np.sqrt(((q - self.tree.points[point, :-1]) ** 2).sum(1) + self.tree.points[point, -1] ** 2)
        inside = apart <= (most_in + least_out) / 2
        self._visit(inner, which[inside])
        self._visit(outer, which[~inside])
        gap_out, gap_in = (least_out - apart) * self.factor, (apart - most_in) * self.factor
        radius = self._radius(which)
        self._visit(outer, which[inside & (gap_out <= radius)])
        self._visit(inner, which[~inside & (gap_in <= radius)])


def usable(vectors: DataFrame, id: str, embedding: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, but for the length."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    sound = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    some = F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.filter(sound & some & F.col(f"`{id}`").isNotNull())
    return rows.select(F.col(f"`{id}`").cast("bigint").alias("vec_id"), v.alias("vector"))


def nearest(
    vectors: DataFrame,
    *,
    is_query: Column | None = None,
    id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 20,
    factor: float = 1.0,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the `k` nearest to each query row, by default ids divisible by 20."""
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    out = "query_id bigint, vec_id bigint, score double, shard bigint"
    rows = usable(vectors, id, embedding)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    kinds = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square"))
    kind = kinds.orderBy(F.desc("n"), F.desc("width")).first()
    if kind is None:
        empty = vectors.sparkSession.createDataFrame([], out)
        return empty.select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    width, longest, shards = kind["width"], float(kind["square"]) ** 0.5 * (1 + 1e-12), -(-kind["n"] // SHARD_ROWS)
    rows = rows.filter(F.size("vector") == width)

    def packed(size: int, which: int):
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin in range(0, batch.num_rows, size):
                    some = batch.slice(begin, size)
                    ids = some.column("vec_id").to_numpy().astype("<i8").tobytes()
                    body = some.column("vector").flatten().to_numpy().astype("<f8").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([which], pa.int32()), pa.array([ids], pa.binary()), pa.array([body], pa.binary())], ["kind", "ids", "body"]
                    )

        return pack

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, tree = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, parts, tree = row["shard"], [], None
                ids, body = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["body"], "<f8").reshape(-1, width)
                if row["kind"] == 0:
                    parts.append((ids, body))
                    continue
                if not parts:
                    continue
                if tree is None:
                    tree = Tree(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), longest)
                found = Search(tree, ids, body, k, factor)
                real = np.isfinite(found.scores)
                query = np.broadcast_to(ids[:, None], real.shape)[real]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), pa.array(found.found[real]), pa.array(found.scores[real]), pa.array(np.full(len(query), shard))],
                    ["query_id", "vec_id", "score", "shard"],
                )

    schema = "kind int, ids binary, body binary"
    shard_of = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards))
    # A shard's vectors come before the queries; both are streams, so a task holds one shard and one block.
    dealt = rows.withColumn("shard", shard_of)
    points = dealt.select("shard", F.lit(0).alias("kind"), "vec_id", "vector")

    def pack_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            for s in np.unique(shard):
                some = batch.filter(pa.array(shard == s))
                for one in packed(1024, 0)([some.select(["vec_id", "vector"])]):
                    yield pa.RecordBatch.from_arrays([pa.array([int(s)], pa.int64()), *one.columns], ["shard", "kind", "ids", "body"])

    points = points.mapInArrow(pack_points, f"shard bigint, {schema}")
    queries = rows.filter(is_query).mapInArrow(packed(BLOCK_ROWS, 1), schema)
    queries = queries.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"), "kind", "ids", "body")
    both = points.unionByName(queries).repartition("shard").sortWithinPartitions("shard", "kind")
    hits = both.mapInArrow(search, out)
    best = [F.desc("score"), F.col("vec_id")]
    if shards > 64:  # merge groups of shards first, so that no task gets all hits of a query
        part = Window.partitionBy("query_id", F.col("shard") % 64).orderBy(*best)
        hits = hits.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= k).drop("r")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best))
    hits = hits.withColumn("rank", rank).filter(F.col("rank") <= k)
    return hits.select("query_id", "rank", "vec_id", "score")


NEAREST_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])), lambda a, b: a + b) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20"""
