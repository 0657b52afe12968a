"""Nearest-neighbour search over cells: approximate, or exact with cells skipped by their radius.

Vectors are assigned to the nearest of a bounded number of centroids, their *cell*. Stored, the cell
is a partition column, so a query that visits a few cells reads only their files. A cell with a large
share of the rows is simply many files: nothing is grouped or shuffled by cell at query time.
The search inside the visited cells is the exact one.

With the radius of every cell known (the largest distance of a member to the centroid) a cell can be
ruled out for certain: no member is nearer to the query than the centroid is, less the radius.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.errors import ValidationError
from kinfold.functions.filters import Filter, apply_filters
from kinfold.operators.get import included_columns
from kinfold.operators.search import (
    HIT_BYTES,
    attach,
    check_k,
    check_space,
    check_vector,
    collected_hits,
    ensure_checkpoint_dir,
    hits_of_queries,
    nearest_of,
)
from kinfold.plans.sizing import broadcast_limit
from kinfold.schema import ORDER

# Centroids travel with every task, so their number is bounded.
MAX_CELLS = 16_384


@dataclass(frozen=True)
class Cells:
    """Centroids of the cells, one row each, and their radii if they were measured."""

    centroids: np.ndarray
    radii: np.ndarray | None = None

    @property
    def count(self) -> int:
        return len(self.centroids)

    def nearest(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        """For each vector the numbers of its `probes` nearest centroids."""
        c, n = self.centroids, max(1, min(probes, self.count))
        gaps = np.einsum("ij,ij->i", c, c)[None, :] - 2.0 * (vectors @ c.T)
        if n == 1:
            return gaps.argmin(axis=1)[:, None]
        if n == self.count:
            return np.argsort(gaps, axis=1, kind="stable")
        near = np.argpartition(gaps, n - 1, axis=1)[:, :n]
        order = np.lexsort((near, np.take_along_axis(gaps, near, axis=1)), axis=1)
        return np.take_along_axis(near, order, axis=1)

    def reachable(self, vectors: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which cells can hold a row within the (squared) bound of each query; all, if it has none."""
        mask = np.empty((len(vectors), self.count), bool)
        own = np.einsum("ij,ij->i", self.centroids, self.centroids)
        for a in range(0, len(vectors), 256):
            v, bound = vectors[a : a + 256], bounds[a : a + 256, None]
            reach = own[None, :] + np.einsum("ij,ij->i", v, v)[:, None]
            # A little slack for rounding: visiting a cell too many is harmless.
            gap = np.maximum(reach - 2.0 * (v @ self.centroids.T) - 1e-12 * reach, 0.0)
            lowest = np.maximum(np.sqrt(gap) - self.radii, 0.0)
            mask[a : a + 256] = ~(lowest**2 > bound * (1 + 1e-9) + 1e-12)
        return mask

    def visits(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        mask = np.zeros((len(vectors), self.count), bool)
        np.put_along_axis(mask, self.nearest(vectors, probes), True, axis=1)
        return mask


def train_cells(
    df: DataFrame, cells: int, seed: int = 42, iterations: int = 10, training_fraction: float = 1.0
) -> Cells:
    """Find centroids by k-means. A training fraction below 1 affects only where the centroids lie;
    every vector is assigned to a cell in any case."""
    if not 1 <= cells <= MAX_CELLS:
        raise ValidationError(f"the number of cells must be between 1 and {MAX_CELLS}")
    vectors = df.filter(F.col("embedding").isNotNull()).select(array_to_vector("embedding").alias("features"))
    if training_fraction < 1.0:
        vectors = vectors.sample(training_fraction, seed)
    model = KMeans(k=cells, seed=seed, maxIter=iterations).fit(vectors)
    return Cells(np.array(model.clusterCenters(), dtype=np.float64))


def cell_of(vector: Column, cells: Cells) -> Column:
    """Number of the nearest centroid."""

    @F.pandas_udf("int")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            # Slices keep the vector-by-centroid matrix small.
            near = [
                cells.nearest(np.stack(v.iloc[a : a + 1024]).astype(np.float64), 1)[:, 0]
                for a in range(0, len(v), 1024)
            ]
            yield pd.Series(np.concatenate(near) if near else np.empty(0), dtype="int32")

    return assign(vector)


def assign_cells(df: DataFrame, cells: Cells) -> DataFrame:
    """The records that have a vector, with their cell."""
    return df.filter(F.col("embedding").isNotNull()).withColumn("_cell", cell_of(F.col("embedding"), cells))


def with_radii(assigned: DataFrame, cells: Cells) -> Cells:
    """`cells` with the largest distance of a member to its centroid; an empty cell has radius 0."""

    @F.pandas_udf("double")
    def gap(vectors: pd.Series, numbers: pd.Series) -> pd.Series:
        out = np.empty(len(vectors))
        for a in range(0, len(vectors), 1024):
            x = np.stack(vectors.iloc[a : a + 1024]).astype(np.float64)
            out[a : a + 1024] = np.sqrt(np.square(x - cells.centroids[numbers.iloc[a : a + 1024]]).sum(axis=1))
        return pd.Series(out)

    # One number per cell, and the number of cells is bounded.
    sizes = assigned.groupBy("_cell").agg(F.max(gap("embedding", "_cell")).alias("radius")).collect()
    radii = np.zeros(cells.count)
    for r in sizes:
        radii[r["_cell"]] = r["radius"]
    return Cells(cells.centroids, radii)


def write_cells(df: DataFrame, cells: Cells, path: str) -> None:
    """Store the records partitioned by cell, the centroids and radii beside them.

    Rows are rebalanced by cell before the write: adaptive execution merges small cells into one task
    and splits a hot one over many, so files come out even whatever the sizes of the cells.
    """
    assigned = assign_cells(df, cells).hint("rebalance", F.col("_cell"))
    assigned.write.partitionBy("_cell").parquet(f"{path}/records")
    spark = df.sparkSession
    measured = with_radii(spark.read.parquet(f"{path}/records"), cells)
    rows = [(i, [float(x) for x in c], float(measured.radii[i])) for i, c in enumerate(cells.centroids)]
    table = spark.createDataFrame(rows, "cell int, centroid array<double>, radius double")
    table.coalesce(1).write.parquet(f"{path}/centroids")


def read_cells(spark: SparkSession, path: str) -> tuple[DataFrame, Cells]:
    """Records and centroids as :func:`write_cells` stored them."""
    table = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
    return spark.read.parquet(f"{path}/records"), Cells(
        np.array([r["centroid"] for r in table]), np.array([r["radius"] for r in table])
    )


def approximate_knn_join(
    assigned: DataFrame,
    cells: Cells,
    queries: DataFrame,
    k: int = 10,
    probes: int = 4,
    where: Filter = None,
    where_document: Filter = None,
    space: str = "l2",
    qid: str = "qid",
    embedding: str = "embedding",
    include_metadatas: bool = True,
    include_documents: bool = True,
) -> DataFrame:
    """The k nearest records of every query vector among the `probes` cells nearest to it.

    `assigned` carries a ``_cell`` column. Visiting every cell gives the exact result.
    """
    check_k(k)
    check_space(space)
    rows = apply_filters(assigned, where, where_document)
    dim = cells.centroids.shape[1]
    hits, total = hits_of_queries(rows, queries, k, space, qid, embedding, dim, lambda v, _: cells.visits(v, probes))
    shown = [c for c in included_columns(assigned, False, include_metadatas, include_documents) if c != "_cell"]
    small = total * HIT_BYTES <= broadcast_limit(assigned.sparkSession)
    return attach(rows, hits, shown, small).select("qid", "rank", *shown, "distance")


def pruned_knn_join(
    assigned: DataFrame,
    cells: Cells,
    queries: DataFrame,
    k: int = 10,
    probes: int = 4,
    where: Filter = None,
    where_document: Filter = None,
    qid: str = "qid",
    embedding: str = "embedding",
    include_metadatas: bool = True,
    include_documents: bool = True,
) -> DataFrame:
    """The exact k nearest records (squared L2) of every query vector, reading only cells in reach.

    The `probes` nearest cells give the distance of a k-th record, which bounds that of the true one.
    A second pass reads the cells that are not ruled out by that bound. `cells` needs radii.
    """
    check_k(k)
    if cells.radii is None:
        raise ValidationError("the radii of the cells are not known: see with_radii")
    rows = apply_filters(assigned, where, where_document)
    dim = cells.centroids.shape[1]
    options = dict(space="l2", qid="qid", embedding="v", dim=dim)
    queries = queries.select(F.col(qid).alias("qid"), F.col(embedding).cast("array<float>").alias("v"))
    first, _ = hits_of_queries(rows, queries, k, visits=lambda v, _: cells.visits(v, probes), **options)
    # One number per query, used twice below: kept, so that the first pass runs once.
    ensure_checkpoint_dir(rows)
    kth = first.filter(F.col("rank") == k).select("qid", F.col("distance").alias("bound")).checkpoint()
    bounded = queries.join(kth, "qid", "left").select("qid", "v", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    hits, total = hits_of_queries(
        rows,
        bounded,
        k,
        visits=lambda v, table: cells.reachable(v, table.column("bound").to_numpy()),
        extra=["bound"],
        **options,
    )
    shown = [c for c in included_columns(assigned, False, include_metadatas, include_documents) if c != "_cell"]
    small = total * HIT_BYTES <= broadcast_limit(assigned.sparkSession)
    return attach(rows, hits, shown, small).select("qid", "rank", *shown, "distance")


def approximate_knn(
    assigned: DataFrame, cells: Cells, vector: Sequence[float], k: int = 10, probes: int = 4, **options
) -> DataFrame:
    """The k nearest records of one vector among the `probes` cells nearest to it."""
    one = assigned.sparkSession.createDataFrame(
        [(0, [float(x) for x in vector])], "qid bigint, embedding array<float>"
    )
    return approximate_knn_join(assigned, cells, one, k, probes, **options).drop("qid").orderBy("rank")


def widening_knn(
    records: DataFrame,
    cells: Cells,
    vector: Sequence[float],
    k: int = 10,
    where: Filter = None,
    where_document: Filter = None,
    first: int = 2,
    include_metadatas: bool = True,
    include_documents: bool = True,
) -> DataFrame:
    """The exact k nearest records (squared L2) of one vector under filters, cell by cell.

    Cells come in order of the least distance that a member can have: that of the centroid less the radius.
    After each round the k-th match found so far bounds the true one, and the search ends when no cell left
    can hold a nearer one. A round takes twice the cells of the round before, so a filter that hardly
    anything passes costs few rounds. Over stored cells a round reads only their partitions. `cells` needs radii; the
    k hits pass through the driver.
    """
    check_k(k)
    if cells.radii is None:
        raise ValidationError("the radii of the cells are not known: see with_radii")
    q = check_vector(vector, cells.centroids.shape[1])
    gaps = np.sqrt(np.square(cells.centroids - q).sum(axis=1))
    # A little slack for rounding: visiting a cell too many is harmless.
    lowest = np.maximum(gaps * (1 - 1e-9) - cells.radii * (1 + 1e-9) - 1e-9, 0.0) ** 2
    order = np.argsort(lowest, kind="stable")
    rows = apply_filters(records, where, where_document)
    hits: list = []
    bound, at, step, schema = np.inf, 0, max(1, first), None
    while at < len(order):
        taken = [int(c) for c in order[at : at + step] if lowest[c] <= bound]
        if not taken:
            break
        found = nearest_of(rows.filter(F.col("_cell").isin(taken)), vector, k)
        schema = found.schema
        hits += found.collect()
        hits.sort(key=lambda r: (r["distance"], *((r[c] is not None, r[c] or 0) for c in ORDER)))
        hits = hits[:k]
        if len(hits) == k:
            bound = hits[-1]["distance"] * (1 + 1e-12)
        at, step = at + step, 2 * step
    spark = records.sparkSession
    place, few = collected_hits(spark.createDataFrame(hits, schema))
    shown = [c for c in included_columns(records, False, include_metadatas, include_documents) if c != "_cell"]
    visited = rows.filter(F.col("_cell").isin([int(c) for c in order[:at]]) & place)
    return attach(visited, few, shown, small=True).orderBy("distance", *ORDER).limit(k).select(*shown, "distance")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that were found, over all queries (one row)."""
    want = exact.select("qid", "id")
    got = found.select("qid", "id", F.lit(1).alias("hit"))
    return want.join(got, ["qid", "id"], "left").agg(
        F.count(F.lit(1)).alias("expected"), F.count("hit").alias("found"), (F.count("hit") / F.count(F.lit(1))).alias("recall")
    )
