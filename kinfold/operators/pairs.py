"""Pairs of records under a distance threshold: a metric range join.

1. Equal vectors become one, with a count, so a vector that makes up a third of the records costs one row.
2. Pivots are drawn from a bounded sample; every vector belongs to the nearest, its *home* cell. A vector within
   `radius` of one at home in cell j lies at most twice the radius nearer to its own pivot than to pivot
   j, and no farther from pivot j than that cell reaches plus the radius. A copy goes to just those cells.
3. Every pair is met once: in the cell of the two homes that has the larger number, or at home.
4. A cell with many vectors is cut into blocks, dealt to tasks of their own. A task holds one
   block, and the vectors that may have partners in it pass by in batches.
5. Tasks count links per vector and join linked vectors to local components, of which only one link per
   vector leaves the task. So the result grows with the vectors and their copies, however many pairs there are.

Components then meet over shared vectors by spreading the smallest label, level by level.

Records without a vector, and vectors with a component that is null or not finite, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.errors import ValidationError
from kinfold.operators.search import ensure_checkpoint_dir
from kinfold.plans.sizing import fits

#: Records that pivots are drawn from, whatever the size of the table.
PIVOT_SAMPLE = 20_000
#: Most pivots; they travel with every task.
MOST_PIVOTS = 4_096
#: Vectors of the sample that show how many cells a vector meets, and comparisons that cost as much as a copy.
PROBED, COPY_COST = 1_000, 200
#: Vectors of a cell that one task holds.
BLOCK_ROWS = 8_192
#: Cells of one distance matrix inside a task.
MATRIX_CELLS = 2_000_000


@dataclass(frozen=True)
class Pivots:
    points: np.ndarray
    reach: np.ndarray  # largest distance of a vector at home to the pivot

    def distances(self, x: np.ndarray) -> np.ndarray:
        own = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", self.points, self.points)[None, :]
        return np.sqrt(np.maximum(own - 2.0 * (x @ self.points.T), 0.0))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def distinct_vectors(records: DataFrame) -> DataFrame:
    """Equal vectors as one row: node (smallest id), v, n."""
    sound = records.filter(
        F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    # + 0.0 makes the two zeros one, as they are equal.
    v = F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("float"))
    return sound.select("id", v.alias("v")).groupBy("v").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n"))


def choose_pivots(nodes: DataFrame, dim: int, radius: float, seed: int = 1) -> Pivots:
    """Pivots by k-means++ over a bounded sample, as many as promise the least work.

    More pivots rule out more comparisons where the radius is small beside the distances, and cost copies of
    each vector where it is not. The sample shows which share of the cells a vector meets.
    """
    rows = nodes.count()
    drawn = nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(PIVOT_SAMPLE).select("v").toArrow()
    sample = _vectors(drawn.column("v").combine_chunks(), dim)
    draw = np.random.default_rng(seed)
    points = [sample[0]] if len(sample) else [np.zeros(dim)]
    gap = np.square(sample - points[0]).sum(axis=1)
    most = min(MOST_PIVOTS, len(sample), max(1, rows * 64 // BLOCK_ROWS))
    while len(points) < most and gap.sum() > 0:
        points.append(sample[draw.choice(len(sample), p=gap / gap.sum())])
        gap = np.minimum(gap, np.square(sample - points[-1]).sum(axis=1))
    pivots = Pivots(np.array(points), np.full(len(points), np.inf))
    d = pivots.distances(sample[:PROBED])
    choices = []
    for n in [*(4**k for k in range(8) if 4**k < len(points)), len(points)]:
        share = float((d[:, :n] - d[:, :n].min(axis=1, keepdims=True) <= 2 * radius).mean()) if len(d) else 1.0
        copies = 1 + share * max(n, rows / BLOCK_ROWS) / 2
        choices.append((share * rows / 2 + COPY_COST * copies, n))
    least = min(choices)[1]
    return Pivots(pivots.points[:least], pivots.reach[:least])


def _homes(nodes: DataFrame, pivots: Pivots, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, MATRIX_CELLS // len(pivots.points))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                d = pivots.distances(_vectors(part.column("v"), dim))
                home = d.argmin(axis=1)
                columns = [*part.columns, pa.array(home.astype(np.int32)), pa.array(d[np.arange(len(d)), home])]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "home", "gap"])

    return nodes.select("node", "v", "n").mapInArrow(run, "node string, v array<float>, n bigint, home int, gap double")


def _dealt(homes: DataFrame, pivots: Pivots, blocks: np.ndarray, radius: float, dim: int) -> DataFrame:
    """A row per vector and block that it meets: cell, block, held (whether it is a member of the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, MATRIX_CELLS // len(pivots.points))
        cells = np.arange(len(pivots.points))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                d = pivots.distances(_vectors(part.column("v"), dim))
                home = part.column("home").to_numpy()
                own = d[np.arange(len(d)), home]
                slack = 1e-6 * (1.0 + d.max(initial=0.0))  # a copy too many does no harm
                meets = (d - own[:, None] <= 2 * radius + slack) & (d <= pivots.reach + radius + slack) & (cells > home[:, None])
                rows, there = np.nonzero(meets)
                # Every block of the other cells; at home the own block as a member, and the later ones.
                number = part.column("block").to_numpy()
                times = blocks[there]
                who = [np.arange(len(d)), np.repeat(rows, times)]
                cell = [home, np.repeat(there, times)]
                block = [number, np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)]
                later = blocks[home] - 1 - number
                who.append(np.repeat(np.arange(len(d)), later))
                cell.append(np.repeat(home, later))
                block.append(np.arange(int(later.sum())) - np.repeat(np.cumsum(later) - later, later) + np.repeat(number + 1, later))
                who, cell, block = (np.concatenate(x) for x in (who, cell, block))
                taken = part.select(["node", "v", "n"]).take(pa.array(who))
                held = pa.array(np.arange(len(who)) < len(d))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(block.astype(np.int32)), held, *taken.columns],
                    ["cell", "block", "held", "node", "v", "n"],
                )

    return homes.mapInArrow(run, "cell int, block int, held boolean, node string, v array<float>, n bigint")


class _Local:
    """Union-find over the vectors of one block and those that pass by."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, a: str) -> str:
        root = a
        while self.parent.setdefault(root, root) != root:
            root = self.parent[root]
        while self.parent[a] != root:
            self.parent[a], a = root, self.parent[a]
        return root

    def join(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _links(dealt: DataFrame, radius: float, dim: int) -> DataFrame:
    """node, other (a linked vector of the same local component, or null), links (records linked here)."""
    bound = radius * radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, local, links = None, [], _Local(), {}

        def shown() -> Iterator[pa.RecordBatch]:
            names = list(links)
            for at in range(0, len(names), 50_000):
                some = names[at : at + 50_000]
                roots = [local.find(x) for x in some]
                others = [None if r == x else r for x, r in zip(some, roots)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.string()), pa.array(others, pa.string()), pa.array([links[x] for x in some], pa.int64())],
                    ["node", "other", "links"],
                )

        def meet(names_a, x, n_a, names_b, y, n_b, same: bool) -> None:
            """Pairs of a (held) and b (passing), or within a."""
            if not len(x) or not len(y):
                return
            xx, yy = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
            slack = 1e-13 * (dim + 8) * (xx.max() + yy.max())
            step = max(1, MATRIX_CELLS // len(x))
            for at in range(0, len(y), step):
                rough = yy[at : at + step, None] + xx[None, :] - 2.0 * (y[at : at + step] @ x.T)
                b, a = np.nonzero(rough <= bound + slack)
                if same:
                    b, a = b[a < b + at], a[a < b + at]
                if not len(a):
                    continue
                # Near the bound the difference itself decides, summed alike for every pair.
                sure = rough[b, a] < bound - slack
                open_ = np.flatnonzero(~sure)
                for s in range(0, len(open_), 65_536):
                    part = open_[s : s + 65_536]
                    sure[part] = np.square(y[b[part] + at] - x[a[part]]).sum(axis=1) <= bound
                a, b = a[sure], b[sure] + at
                for names, here, counts in ((names_a, a, n_b[b]), (names_b, b, n_a[a])):
                    sums = np.bincount(here, counts, len(names)).astype(np.int64)
                    for k in np.flatnonzero(sums):
                        links[names[k]] = links.get(names[k], 0) + int(sums[k])
                # One link per passing vector to each local component is enough.
                roots = np.array([local.find(names_a[k]) for k in np.unique(a)], object)
                root_number = {r: k for k, r in enumerate(dict.fromkeys(roots))}
                number = np.zeros(len(names_a), np.int64)
                number[np.unique(a)] = [root_number[r] for r in roots]
                first = np.unique(b * (len(root_number) + 1) + number[a], return_index=True)[1]
                for k in first:
                    local.join(names_a[a[k]], names_b[b[k]])

        for batch in batches:
            cells, numbers = batch.column("cell").to_numpy(), batch.column("block").to_numpy()
            change = np.flatnonzero((np.diff(cells) != 0) | (np.diff(numbers) != 0)) + 1
            for a, b in zip(np.r_[0, change], np.r_[change, batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(int(a), int(b - a))
                if key != (cells[a], numbers[a]):
                    yield from shown()
                    key, members, local, links = (cells[a], numbers[a]), [], _Local(), {}
                held = part.column("held").to_numpy(zero_copy_only=False)
                x, n = _vectors(part.column("v"), dim), part.column("n").to_numpy()
                names = np.array(part.column("node").to_pylist(), object)
                new = (names[held], x[held], n[held])
                meet(*new, *new, True)
                for old in members:  # members come first, so passing rows meet all of them
                    meet(*old, names, x, n, False)
                if held.any():
                    meet(*new, names[~held], x[~held], n[~held], False)
                    members.append(new)
        yield from shown()

    rows = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", F.desc("held"))
    return rows.mapInArrow(run, "node string, other string, links bigint")


def spread_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its connected component.

    Edges turn towards the smallest neighbour until each component is a star: in one step every node
    links its larger neighbours to the smallest, in the other its neighbours that are smaller. The number of rounds grows
    with the logarithm of a component's diameter. The smallest neighbour comes from an aggregate, which
    sums up in tasks first, and joins follow on the node of an edge, so no neighbourhood is gathered.
    """
    ensure_checkpoint_dir(edges)
    current = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    state = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of a node, and the node itself, to the smallest around it.
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        # Smaller neighbours, and the node itself, to the smallest among them.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        current = joined.filter("a <> b").distinct().checkpoint()
        now = current.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if now == state:
            break
        state = now
    label = F.coalesce(F.col("b"), F.col("node")).alias("label")
    return nodes.join(current, F.col("node") == F.col("a"), "left").select("node", label)


def range_join(records: DataFrame, radius: float, dim: int | None = None) -> DataFrame:
    """How each record is linked to those within `radius` (Euclidean distance, the bound included).

    A row per record with a usable vector: id, links (other records within the radius, equal vectors included),
    class_id (the smallest id among all records reached over links).
    """
    if not radius >= 0:
        raise ValidationError("the radius must not be negative")
    ensure_checkpoint_dir(records)
    if dim is None:
        row = records.filter(F.col("embedding").isNotNull()).agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
        if row[0] is None:
            return records.limit(0).select("id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("class_id"))
        if row[0] != row[1] or row[0] < 1:
            raise ValidationError("all vectors must have the same number of components")
        dim = row[0]
    nodes = distinct_vectors(records).checkpoint()
    pivots = choose_pivots(nodes, dim, radius)
    homes = _homes(nodes, pivots, dim).checkpoint()
    # One row per pivot.
    sizes = homes.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("reach")).collect()
    blocks, reach = np.zeros(len(pivots.points), np.int64), np.full(len(pivots.points), -np.inf)
    for r in sizes:
        blocks[r["home"]], reach[r["home"]] = -(-r["n"] // BLOCK_ROWS), r["reach"]
    pivots = Pivots(pivots.points, reach)
    counts = F.element_at(F.lit(blocks.tolist()), F.col("home") + 1)
    placed = homes.withColumn("block", F.pmod(F.xxhash64("node"), counts).cast("int"))
    found = _links(_dealt(placed, pivots, blocks, radius, dim), radius, dim).checkpoint()
    labels = spread_labels(nodes.select("node"), found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("linked"))
    known = nodes.join(linked, "node", "left").join(labels, "node")
    known = known.select("v", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("links"), F.col("label").alias("class_id"))
    known = F.broadcast(known) if fits(known) else known
    v = F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("float"))
    return records.select("id", v.alias("v")).join(known, "v").select("id", "links", "class_id")
