"""Documents packed into sequences of a fixed length by shortest-pack-first over the length histogram.

Texts are encoded, an id is appended, and what is longer than a sequence is cut into full sequences
and a rest. The histogram of piece lengths, with one row per length, is all that the driver sees: it
places lengths longest first into the pack with most room, keeping packs as patterns with counts.
Patterns are then joined back to the pieces by the rank of a piece among those of its length.

Null text counts as empty: such a document is one piece with the appended id. Repeated rows are packed
as often as they occur. An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import plain, slices, spread_text, stored, text_or_empty
from kinfold.llm.tokens import STEP_BYTES, default_vocabulary, encoder

PIECES = "doc_id bigint, start bigint, length int, ids_crc32 bigint, doc_tokens bigint, part int, local_rank bigint"
SLOTS = "length int, first_rank bigint, last_rank bigint, copies int, first_sequence bigint, slot_offset bigint"

#: Words that a worker remembers while it packs, beside what other stages of a pipeline left in the executor.
REMEMBERED = 250_000
#: A pattern: the lengths in a pack with how often each occurs.
Pattern = tuple[tuple[int, int], ...]


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, Pattern]]:
    """Patterns and how many packs have each, for so many pieces of each length.

    Lengths are placed longest first, always into the shortest packs. All packs of a pattern are
    handled at once, so the work depends on the number of lengths, not of pieces: a length opens at
    most two patterns and splits at most one in two.
    """
    if not all(0 < length <= size and n >= 0 for length, n in histogram.items()):
        raise ValueError(f"lengths must be between 1 and {size}")
    room: list[tuple[int, int, int, Pattern]] = []  # a heap: less room, tie, packs, pattern
    done: list[tuple[int, Pattern]] = []
    tie = 0

    def put(gap: int, packs: int, pattern: Pattern) -> None:
        nonlocal tie
        tie += 1
        if packs and gap:
            heapq.heappush(room, (-gap, tie, packs, pattern))
        elif packs:
            done.append((packs, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if room and -room[0][0] >= length:
                gap, _, packs, pattern = heapq.heappop(room)
                gap, copies = -gap, 1
                used = min(packs, left)
                put(gap, packs - used, pattern)
                left -= used
            else:  # no pack has room: open as few new ones as hold the rest
                gap, copies, pattern = size, min(size // length, left), ()
                used = left // copies
                left -= used * copies
            if pattern and pattern[-1][0] == length:
                pattern = (*pattern[:-1], (length, pattern[-1][1] + copies))
            else:
                pattern = (*pattern, (length, copies))
            put(gap - length * copies, used, pattern)
    return done + [(packs, pattern) for _, _, packs, pattern in room]


def slots(patterns: list[tuple[int, Pattern]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length of each pattern, the ranks of the pieces that fill it (`SLOTS`)."""
    rows, used, sequence = [], {}, 0
    for packs, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            first = used.get(length, 0)
            used[length] = first + packs * copies
            rows.append((length, first, used[length] - 1, copies, sequence, offset))
            offset += length * copies
        sequence += packs
    return rows


def pieces(
    docs: DataFrame, *, size: int, id: str = "doc_id", text: str = "text", end_id: int = 0, vocabulary: str | None = None
) -> DataFrame:
    """Pieces of all documents, each numbered among those of its length in its task."""
    vocabulary = vocabulary or default_vocabulary()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tokens, seen = TaskContext.get().partitionId(), encoder(vocabulary, end_id, REMEMBERED), {}
        schema = pa.schema(
            [(n, pa.int32() if n in ("length", "part") else pa.int64()) for n in (x.split()[0] for x in PIECES.split(", "))]
        )
        for batch in slices(batches, "text", STEP_BYTES):
            rows = []
            ids, ends = tokens(batch.column("text"))
            for doc, begin, end in zip(batch.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                for at in range(begin, end, size):
                    piece = ids[at : min(at + size, end)]
                    length = len(piece)
                    rank = seen[length] = seen.get(length, -1) + 1
                    rows.append((doc, at - begin, length, zlib.crc32(piece), end - begin, part, rank))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    rows = plain(docs, doc_id=id, text=text).select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    return spread_text(rows).mapInArrow(cut_up, PIECES)


def pack(docs: DataFrame, *, size: int = 1024, **options) -> DataFrame:
    """Where each piece lies: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    rows = stored(pieces(docs, size=size, **options), "pieces")
    counts = rows.groupBy("part", "length").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    # At most two patterns per length, each with fewer than sqrt(2 * size) lengths: a few MB for any corpus.
    places = F.broadcast(spark.createDataFrame(slots(pack_histogram(histogram, size)), SLOTS))
    ranked = rows.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    placed = ranked.join(places, "length").filter("rank between first_rank and last_rank")
    at = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id",
        "start",
        F.col("length").cast("bigint"),
        "ids_crc32",
        "doc_tokens",
        (F.col("first_sequence") + F.floor(at / F.col("copies"))).cast("bigint").alias("sequence_id"),
        (F.col("slot_offset") + at % F.col("copies") * F.col("length")).cast("bigint").alias("offset"),
    )
