"""Near-duplicate documents by weighted MinHash of word shingles, banded and verified.

A text is the multiset of its runs of five words (of all its words, if it has one to four). BagMinHash
gives it a signature: counts are discretised into dyadic levels, each level of a shingle carries a
Poisson process whose points fall on the registers of the signature, points inside a level are thinned
by the count, and a register keeps its earliest point. Two texts agree in a register with a chance
equal to their weighted Jaccard similarity.

Registers are banded. Texts that meet in a band are compared by their whole multisets: all pairs of
small buckets; in a large bucket each text with the most central one (that which meets most others),
then what is not connected again with the most central of the rest, and what still stands apart with
every text of the bucket, block by block. With 25 bands of 5 a pair at the threshold is missed with a
chance below 0.0001. Links make classes, transitively.

Copies of a text are one text throughout; they share its class. Texts without words are copies of each
other only. Null text counts as empty, null ids never name a class unless it has no other. Repeated rows
are copies. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import RangeHash, cut, flat_bytes, forget_words, mixed, runs_of, slices, spread_text, stored, text_or_empty, word_bounds
from kinfold.plans.sizing import fits

SHINGLE = 5
BANDS, ROWS = 25, 5
#: Texts of a bucket among which all pairs are compared.
SMALL_BUCKET = 12
#: Text bytes signed in one step.
SIGNED_BYTES = 1 << 18
#: Texts of a block, about, where large buckets are compared in blocks.
BLOCK_TEXTS = 128


def shingles_of(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle, repeated as often as it occurs, in order of rows."""
    begin, end, first = word_bounds(raw, at)
    hashes, words = RangeHash(raw)(begin, end), np.diff(first)
    runs, start = runs_of(hashes, first, SHINGLE)
    row = np.searchsorted(first, start, "right") - 1
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            more = words[short] > k
            value[more] = mixed(value[more] * np.uint64(31) + hashes[first[short[more]] + k])
        runs, row = np.concatenate([runs, value]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        runs, row = runs[order], row[order]
    return runs, row


def signatures(shingle: np.ndarray, row: np.ndarray, rows: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """The earliest point in every register of each row (infinity for a row without shingles)."""
    keys, first, count = np.unique(mixed(shingle ^ mixed(row.astype(np.uint64))), return_index=True, return_counts=True)
    shingle, row = shingle[first], row[first]
    total = np.bincount(row, count, minlength=rows)
    out = np.full((rows, registers), np.inf)
    # Level 0 is [0, 1); level q is [2 ** (q - 1), 2 ** q). A count takes part in levels that begin below it.
    element, level = [np.arange(len(count))], [np.zeros(len(count), np.int64)]
    q = 1
    while (more := np.flatnonzero(count > 2 ** (q - 1))).size:
        element.append(more)
        level.append(np.full(len(more), q))
        q += 1
    element, level = np.concatenate(element), np.concatenate(level)
    width = np.where(level == 0, 1, 2.0 ** (level - 1))
    todo, horizon = np.flatnonzero(total > 0), np.log(registers) + 3
    while len(todo):
        limit = np.zeros(rows)
        limit[todo] = horizon / total[todo]
        live = np.flatnonzero(limit[row[element]] > 0)
        state = mixed(shingle[element[live]] + level[live].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        time = np.zeros(len(live))
        while len(live):
            state = mixed(state + np.uint64(0x9FB21C651E98DF25))
            uniform = ((state >> np.uint64(24)).astype(np.float64) + 0.5) / 2.0**40
            time = time - np.log(uniform) / (registers * width[live])
            soon = time <= limit[row[element[live]]]
            live, state, time = live[soon], state[soon], time[soon]
            if not len(live):
                break
            register = ((state & np.uint64(0xFFFF)) * np.uint64(registers)) >> np.uint64(16)
            cell = mixed(state ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(40)
            inside = width[live] + np.floor(cell.astype(np.float64) / 2.0**24 * width[live])
            real = (level[live] == 0) | (inside < count[element[live]])
            place = row[element[live]] * registers + register.astype(np.int64)
            np.minimum.at(out.reshape(-1), place[real], time[real])
        # A row with an empty register looks further ahead.
        todo, horizon = todo[np.isinf(out[todo]).any(1)], horizon * 3
    return out


def bands_of(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    points = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(signature), BANDS)).copy()
    for k in range(ROWS):
        key = mixed(key * np.uint64(31) + points[:, :, k])
    return key.view(np.int64)


def similarity(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of texts, row by row."""
    n = len(a)
    shingle_a, row_a = shingles_of(*flat_bytes(a))
    shingle_b, row_b = shingles_of(*flat_bytes(b))
    row = np.concatenate([row_a, row_b])
    key = mixed(np.concatenate([shingle_a, shingle_b]) ^ mixed(row.astype(np.uint64)))
    sign = np.concatenate([np.ones(len(row_a)), -np.ones(len(row_b))])
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    apart = np.bincount(row[first], np.abs(np.bincount(inverse, sign, minlength=len(first))), minlength=n)
    both = np.bincount(row, minlength=n)
    return np.where(both > 0, (both - apart) / np.maximum(both + apart, 1), 0.0)


def _signed(texts: DataFrame) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in slices(batches, "text", SIGNED_BYTES):
            shingle, row = shingles_of(*flat_bytes(batch.column("text")))
            keys = bands_of(signatures(shingle, row, batch.num_rows))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
            empty = np.bincount(row, minlength=batch.num_rows) == 0
            lists = pa.array([None if e else x for e, x in zip(empty, lists.to_pylist())], pa.list_(pa.int64())) if empty.any() else lists
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), lists], ["doc_id", "node", "bands"])

    return texts.mapInArrow(sign, "doc_id bigint, node binary, bands array<bigint>")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""
    pairs = stored(pairs.select(*_ordered("a", "b")).filter("a <> b").distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    nodes = F.broadcast(nodes) if fits(nodes) else nodes
    bodies = stored(texts.select("node", "text").join(nodes, "node", "left_semi").dropDuplicates(["node"]), "bodies")
    whole = pairs.join(bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    whole = whole.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in slices(batches, "text_b", 1 << 19):
            near = similarity(batch.column("text_a"), batch.column("text_b")) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return stored(whole.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a binary, b binary"), "links")


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node connected with it) of every node that has a link."""
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))), "edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        best = labels.join(near.agg(F.min("label").alias("other")), "node")
        best = best.select("node", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        # Jump to the label of the label.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        best = best.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label"))
        best = cut(best)
        labels = best.select("node", "label")
        if not best.filter("label <> old").limit(1).count():
            return labels


def _star(rows: DataFrame) -> DataFrame:
    """Each text of a bucket with the bucket's most central one: key, a, b."""
    weight = rows.groupBy("node").agg(F.sum("size").alias("weight"))
    leaders = rows.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("b"))
    return rows.select("key", F.col("node").alias("a")).join(leaders, "key")


def overlaps(a: list[str], b: list[str]) -> np.ndarray:
    """Weighted Jaccard similarity of each text of `a` with each of `b`.

    The second occurrence of a shingle is an element of its own, and so on: then shared elements can be
    counted by products of matrices, some thousand elements at a time.
    """
    sides, totals = [], []
    for texts in (a, b):
        shingle, row = shingles_of(*flat_bytes(pa.array(texts, pa.large_string())))
        order = np.lexsort((shingle, row))
        shingle, row = shingle[order], row[order]
        fresh = np.append(True, (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1]))[: len(row)]
        at = np.arange(len(row))
        nth = at - np.maximum.accumulate(np.where(fresh, at, 0)) if len(row) else at
        sides.append((mixed(shingle + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), row))
        totals.append(np.bincount(row, minlength=len(texts)))
    shared = np.intersect1d(sides[0][0], sides[1][0])
    both = np.zeros((len(a), len(b)))
    for begin in range(0, len(shared), 4096):
        part, tables = shared[begin : begin + 4096], []
        for (key, row), texts in zip(sides, (a, b)):
            place = np.minimum(np.searchsorted(part, key), len(part) - 1)
            hit = part[place] == key
            table = np.zeros((len(texts), len(part)), np.float32)
            table[row[hit], place[hit]] = 1
            tables.append(table)
        both += tables[0] @ tables[1].T
    return both / np.maximum(totals[0][:, None] + totals[1][None, :] - both, 1)


def _in_blocks(marked: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links of the texts that stand apart in a large bucket with any text in it.

    Both sides are dealt into blocks, and a task compares two blocks by whole multisets. What leaves it is
    a link for each two labels that have one, never a pair that is not similar.
    """
    keys = marked.filter("apart").select("key").distinct()
    rows = marked.join(F.broadcast(keys) if fits(keys) else keys, "key", "left_semi")
    nodes = rows.select("node").distinct()
    nodes = F.broadcast(nodes) if fits(nodes) else nodes
    bodies = stored(texts.select("node", "text").join(nodes, "node", "left_semi").dropDuplicates(["node"]), "block-bodies")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK_TEXTS))
    whole = rows.join(bodies, "node").withColumn("block", block)
    packed = F.collect_list(F.struct("node", "label", "text"))
    members = whole.groupBy("key", "block").agg(packed.alias("members"))
    apart = whole.filter("apart").groupBy("key", "block").agg(packed.alias("apart"), F.max("size").alias("size"))
    # A copy for each block of the bucket, so that the blocks of a large bucket go to tasks of their own.
    blocks = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("size") / BLOCK_TEXTS) - 1)
    apart = apart.select("key", "apart", F.explode(blocks).alias("block"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = batch.column("apart")[k].as_py(), batch.column("members")[k].as_py()
                near = overlaps([x["text"] for x in a], [x["text"] for x in b]) >= threshold
                found = {}
                for i, j in np.argwhere(near):
                    if a[i]["label"] != b[j]["label"]:
                        found.setdefault((a[i]["label"], b[j]["label"]), (a[i]["node"], b[j]["node"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in found.values()], pa.binary()), pa.array([y for _, y in found.values()], pa.binary())], ["a", "b"]
                )

    pairs = apart.join(members, ["key", "block"]).select("apart", "members")
    return stored(pairs.mapInArrow(compare, "a binary, b binary"), "block-links")


def near_links(signed: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Labels of the nodes that are similar to others."""
    kinds = signed.filter("bands is not null").dropDuplicates(["node"])
    rows = kinds.select("node", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = stored(rows.join(sizes, "key"), "buckets")
    small = rows.filter(F.col("size") <= SMALL_BUCKET).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    small = small.select("nodes").distinct()
    pairs = small.select(F.posexplode("nodes").alias("i", "a"), "nodes")
    pairs = pairs.select("a", F.explode(F.slice("nodes", F.col("i") + 2, F.lit(SMALL_BUCKET))).alias("b"))
    large = rows.filter(F.col("size") > SMALL_BUCKET)
    links = _verified(pairs.union(_star(large).select("a", "b")), texts, threshold)
    labels = components(links)
    for last in (False, True):
        labelled = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        main = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max(F.struct("n", "label"))["label"].alias("main"))
        marked = stored(labelled.join(main, "key").withColumn("apart", F.col("label") != F.col("main")).drop("main"), "marked")
        rest = marked.filter("apart")
        if not rest.limit(1).count():
            break
        if last:
            found = _in_blocks(marked, texts, threshold)
        else:
            more = _star(rest.select("key", "node", "size")).select("a", "b")
            known = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
            more = more.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left").join(known, "b", "left")
            found = _verified(more.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"), texts, threshold)
        links = links.union(found)
        labels = components(links)
    return labels


def _prepared(docs: DataFrame, id: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Per row: doc_id, node, class_id; and per class the row that stays: class_id, doc_id, node."""
    words = text_or_empty(text)
    texts = docs.select(F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.unhex(F.md5(words.cast("binary"))).alias("node"), words.alias("text"))
    signed = stored(_signed(spread_text(texts)), "signatures")
    labels = near_links(signed, texts, threshold)
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    nodes = stored(nodes, "classes")
    tops = nodes.groupBy("label").agg(
        F.min("first").alias("class_id"), F.min(F.struct(F.col("first").isNull(), "first", "node"))["node"].alias("stays"), F.sum("copies").alias("class_size")
    )
    return signed.select("doc_id", "node"), stored(nodes.join(tops, "label"), "tops")


def near_copies(docs: DataFrame, *, id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """A row per document: doc_id, class_id (the smallest id of its class), class_size."""
    rows, classes = _prepared(docs, id, text, threshold)
    return rows.join(classes, "node").select("doc_id", "class_id", "class_size")


def without_near_copies(docs: DataFrame, *, id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """`docs` with one document of each class: that with the smallest id, and one row where rows repeat."""
    rows, classes = _prepared(docs, id, text, threshold)
    staying = classes.filter(F.col("node") == F.col("stays")).select("node", "first", "copies")
    staying = F.broadcast(staying) if fits(staying) else staying
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own_id, own_text = f"c{names.index(id)}", f"c{names.index(text)}"
    kept = numbered.withColumn("node", F.unhex(F.md5(text_or_empty(own_text).cast("binary")))).join(staying, "node")
    kept = kept.filter(F.col(own_id).cast("bigint").eqNullSafe(F.col("first")))
    single, repeated = kept.filter("copies = 1"), kept.filter("copies > 1").dropDuplicates(["node"])
    return single.unionByName(repeated).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
