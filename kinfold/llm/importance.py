r"""Importance resampling towards a target distribution, with weights from bit-sliced sums.

Features of a text are its runs of up to `most_words` words, hashed into buckets. The gain of a bucket is
the scaled and floored log ratio of its smoothed frequencies in the target and in the corpus. The weight of
a text is the floored mean gain of its features, and the draw keeps the highest sums of weight and Gumbel noise.

Weights are exact integers. The counts of a text become bitplanes of one bit per bucket (plane j holds bit
j of each count), and so do the gains, apart for positive and negative ones. The sum over buckets of count
times gain is then the sum over pairs of planes of popcount(counts_j AND gains_i) * 2^(i + j), less the
same over the negative planes.

Bucket counts are summed per batch inside tasks, so the shuffle carries at most one row per bucket and
batch, whatever the corpus. The draw finds the score of the last drawn row from counts per score (scores
are small integers), then sorts by ranges only the rows from there on, and numbers them range by range.

Only A-Z is lower-cased. Null text has no words. A text without features has weight 0. Repeated rows count
each; rows equal in score and id are drawn in any order. A null id reads as an empty text in the noise and comes
last among equal scores. Empty tables: no documents give no rows, an empty target has no features.
Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import flat_bytes, plain, slices, spread_text, stored

#: Ranges longer than this are hashed one by one, so that one long word does not hold up a batch.
LONG = 64
#: Texts whose bitplanes are held at once.
PLANE_ROWS = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0") : ord("9") + 1] = True
_IN_WORD[ord("a") : ord("z") + 1] = True
_IN_WORD[128:] = True  # every byte of a character beyond ASCII


def _crc_table() -> np.ndarray:
    """The table of the reflected CRC-32, one entry per byte, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def crc_of_ranges(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, all ranges one byte further at a time."""
    size, table = end - begin, _crc_table()
    order = np.argsort(-size, kind="stable")
    lengths, place = size[order], begin[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    first = int(np.searchsorted(-lengths, -LONG, "left"))  # longer ones stand before
    live = len(order)
    for k in range(LONG):
        live = int(np.searchsorted(-lengths[:live], -k, "left"))
        if live <= first:
            break
        s = state[first:live]
        state[first:live] = table[(s ^ raw[place[first:live] + k]) & 0xFF] ^ (s >> 8)
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for n in order[:first]:
        out[n] = zlib.crc32(raw[begin[n] : end[n]].tobytes())
    return out


def features(raw: np.ndarray, at: np.ndarray, most_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every feature of the texts in `raw`, and the number of words of each row."""
    raw = _LOWER[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _IN_WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    here, before = inside[1:], inside[:-1]
    begin, end = np.flatnonzero(here & (~before | edge)), np.flatnonzero(before & (~here | edge))
    first = np.searchsorted(begin, at)
    row, words = np.repeat(np.arange(len(at) - 1), np.diff(first)), np.diff(first)
    if most_words == 1:
        return row, (crc_of_ranges(raw, begin, end) % np.uint32(buckets)).astype(np.int64), words
    # Longer runs are ranges of a copy with one space after each word.
    size = end - begin + 1
    upto = np.cumsum(size)
    joined = np.full(int(upto[-1]) if len(upto) else 0, 32, np.uint8)
    source = np.arange(len(joined)) - np.repeat(upto - size, size) + np.repeat(begin, size)
    letter = np.ones(len(joined), bool)
    letter[upto - 1] = False
    joined[letter] = raw[source[letter]]
    rows, found = [], []
    for n in range(1, most_words + 1):
        start = np.arange(max(0, len(begin) - n + 1))
        start = start[row[start] == row[start + n - 1]] if len(start) else start
        rows.append(row[start])
        found.append(crc_of_ranges(joined, (upto - size)[start], upto[start + n - 1] - 1))
    return np.concatenate(rows), (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), words


def bitplanes(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, rows: int, buckets: int) -> list[np.ndarray]:
    """Bits of non-negative values as planes: plane j is a row of packed bits per row, a bit per bucket."""
    width = -(-buckets // 64) * 64
    planes = []
    for j in range(int(value.max(initial=0)).bit_length()):
        table = np.zeros((rows, width), bool)
        on = (value >> j) & 1 == 1
        table[row[on], bucket[on]] = True
        planes.append(np.packbits(table, axis=1, bitorder="little").view(np.uint64))
    return planes


def exact_sums(counts: list[np.ndarray], gains: list[np.ndarray], losses: list[np.ndarray], rows: int) -> np.ndarray:
    """Sum over buckets of count times gain, from the planes of both."""
    total = np.zeros(rows, np.int64)
    for j, plane in enumerate(counts):
        some = np.flatnonzero(plane.any(axis=1))  # few rows have high bits
        part = plane if len(some) == rows else plane[some]
        for sign, other in ((1, gains), (-1, losses)):
            for i, mask in enumerate(other):
                total[some] += sign * (np.bitwise_count(part & mask).sum(axis=1, dtype=np.int64) << (i + j))
    return total


def bucket_counts(texts: DataFrame, buckets: int, most_words: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. Tasks send at most a row per bucket and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(features(*flat_bytes(batch.column("text")), most_words, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    sums = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # at most `buckets` rows
        counts[r["bucket"]] = r["n"]
    return counts


def gains_of(target: np.ndarray, corpus: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the ratio of smoothed frequencies) of each bucket."""
    k = len(target)
    t, s = target.astype(np.float64), corpus.astype(np.float64)
    return np.floor(scale * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, *, most_words: int = 1) -> DataFrame:
    """`docs` (doc_id, text) as doc_id, n_words, n_features, weight."""
    buckets = len(gains)
    where, zero = np.arange(buckets), np.zeros(buckets, np.int64)
    plus = bitplanes(zero, where, np.maximum(gains, 0), 1, buckets)
    minus = bitplanes(zero, where, np.maximum(-gains, 0), 1, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = batch.num_rows
            row, bucket, words = features(*flat_bytes(batch.column("text")), most_words, buckets)
            pairs, count = np.unique(row * buckets + bucket, return_counts=True)
            row, bucket = np.divmod(pairs, buckets)
            size = np.bincount(row, count, n).astype(np.int64)
            total = np.empty(n, np.int64)
            for a in range(0, n, PLANE_ROWS):
                b = min(n, a + PLANE_ROWS)
                part = slice(*np.searchsorted(row, [a, b]))
                planes = bitplanes(row[part] - a, bucket[part], count[part], b - a, buckets)
                total[a:b] = exact_sums(planes, plus, minus, b - a)
            weight = np.where(size > 0, total // np.maximum(size, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words.astype(np.int64)), pa.array(size), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel_noise(doc_id: Column, seed: int, scale: int = 1000) -> Column:
    """floor(-scale * ln(-ln u)), u from the first eight hexadecimal digits of sha256("seed:id")."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def ranked(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """`rows` (stored; doc_id, n_words, n_features, weight, score, able) with the rank of those drawn.

    Of the N able rows, floor(N * share) are drawn.
    """
    spark = rows.sparkSession
    # A row per different score: scores are integers of some tens of thousands at most.
    per_score = rows.filter("able").groupBy("score").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("score")).collect()
    wanted, last = share[0] * sum(r["n"] for r in per_score) // share[1], None
    left = wanted
    for r in per_score:
        if left <= 0:
            break
        left, last = left - r["n"], r["score"]
    kept = rows.columns
    if last is None:
        return rows.withColumn("rank", F.lit(None).cast("bigint"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(n + 1, n + 1 + batch.num_rows)
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(places)], [*batch.schema.names, "part", "place"]
            )

    head = rows.filter(F.col("able") & (F.col("score") >= last)).withColumn("salt", F.rand(3))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    dealt = head.repartitionByRange(*order, "salt").sortWithinPartitions(*order).drop("salt")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part bigint, place bigint"
    placed = stored(dealt.mapInArrow(number, schema), "drawn")
    # A row per range, ordered by one window.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy("part").agg(F.max("place").alias("n"))
    bases = ends.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).collect()
    bases = spark.createDataFrame([(r["part"], r["base"]) for r in bases], "part bigint, base bigint")
    rank = F.col("base") + F.col("place")
    found = placed.join(F.broadcast(bases), "part").select(*kept, F.when(rank <= wanted, rank).alias("rank"))
    rest = rows.filter(~F.col("able") | (F.col("score") < last)).withColumn("rank", F.lit(None).cast("bigint"))
    return found.unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = 10_000,
    most_words: int = 1,
    seed: int = 2024,
    least_words: int = 20,
    share: tuple[int, int] = (10, 100),
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document."""
    docs = spread_text(plain(docs, doc_id=id, text=text)).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    wanted = bucket_counts(plain(target, text=target_text).select(F.col("text").cast("string")), buckets, most_words)
    gains = gains_of(wanted, bucket_counts(docs, buckets, most_words))
    rows = weigh(docs, gains, most_words=most_words)
    rows = rows.withColumns(
        {"score": F.col("weight") + gumbel_noise(F.col("doc_id"), seed), "able": F.col("n_words") >= least_words}
    )
    return ranked(stored(rows, "weights"), share).select("doc_id", "n_features", "weight", "score", "rank")


#: Bytes of a word from its hexadecimal form, then CRC-32 byte by byte through the table built from its polynomial.
IMPORTANCE_SQL = r"""WITH RECURSIVE table_steps(k, c, step) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM table_steps WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY k) AS tbl FROM table_steps WHERE step = 8),
cut AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
aimed AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
spelled AS (SELECT row_number() OVER () AS n, doc_id, words, len(words) AS n_features FROM cut),
used AS (SELECT n, unnest(words) AS w FROM spelled),
distinct_words AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM used UNION SELECT w FROM aimed)),
hashed AS (
  SELECT w, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_words, crc_table),
corpus AS (SELECT n, bucket, count(*) AS c FROM used JOIN hashed USING (w) GROUP BY ALL),
s AS (SELECT bucket, sum(c) AS s FROM corpus GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM aimed JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS all_s, coalesce((SELECT sum(t) FROM t), 0) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST(all_s AS DOUBLE) + 10000)
    / ((CAST(s AS DOUBLE) + 1) * (CAST(all_t AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
sums AS (SELECT n, sum(c * gain) AS total FROM corpus JOIN gains USING (bucket) GROUP BY n),
scored AS (
  SELECT doc_id, n_features, CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM spelled LEFT JOIN sums USING (n)),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM scored),
placed AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
    count(*) FILTER (n_features >= 20) OVER () AS n FROM noisy)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM placed"""
