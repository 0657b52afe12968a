"""Removal of long repeated byte strings with a sparse suffix array.

A byte goes if a string of `length` bytes that covers it also starts elsewhere, in the same text or
another. Suffixes are taken only where a text's own bytes say so: in each string of `length` bytes, at
the leading token (a run of `TOKEN` bytes) with the smallest hash. Equal strings choose the same place, so
every match contains suffixes that both sides took, and every start of a string belongs to one suffix.

1. Exact copies of a text go whole, and one of them stays to compare others with. Leading tokens are
   counted; suffixes whose token occurs once drop out.
2. Suffixes equal over all the strings that belong to them settle those strings at once.
3. The others, which lie at the edges of matches, are dealt to buckets by ranges of their leading bytes
   (Spark samples the splitters); equal tokens meet in one bucket, so nothing is equal across a
   boundary. A bucket sorts the suffixes, and what precedes them, by multikey quicksort eight bytes at a
   time; neighbours' common prefixes tell which strings are equal.
4. A token with more different suffixes than one task may hold is settled by digests of its strings,
   counted by Spark, in place of step 3.

Texts are told apart by two hashes, so copies of a text, however many, share one answer. Null text
counts as empty; texts shorter than `length` keep everything. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import RangeHash, flat_bytes, forget_words, mixed, slices, spread_text, stored, text_or_empty
from kinfold.plans.sizing import fits

TOKEN = 40
#: Text bytes whose suffixes are chosen in one step; it takes about a hundred bytes of arrays for each.
SUFFIX_BYTES = 1 << 18
#: Different suffixes of one leading token that a task compares in memory.
MOST_SUFFIXES = 200_000
#: Suffixes that one step of a bucket takes, if tokens are not split.
STEP = 10_000


def suffixes(raw: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The suffixes taken from each row.

    Row, start of the first string that belongs to the suffix (in the row), number of those strings,
    how far after that start the suffix begins, hash of its leading token, hash of all the strings.
    """
    n, m = len(raw), length - TOKEN + 1
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    hashed = RangeHash(raw)
    place = np.arange(n - TOKEN + 1)
    tokens = hashed(place, place + TOKEN)
    # Hash first, then place: the leftmost of equal tokens wins.
    ranked = (tokens & np.uint64(0xFFFFFFFFF0000000)) | place.astype(np.uint64)
    blocks = -(-len(ranked) // m)
    padded = np.full(blocks * m, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(ranked)] = ranked
    table = padded.reshape(blocks, m)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    best = (np.minimum(behind[:starts], ahead[m - 1 : m - 1 + starts]) & np.uint64(0x0FFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[:starts]
    inside = np.arange(starts) + length <= at[row + 1]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (best[1:] != best[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(first)
    stops = np.flatnonzero(inside & ~np.append(inside[1:] & ~first[1:], False))
    count = stops - begin + 1
    anchor = best[begin]
    whole = hashed(begin, begin + count - 1 + length)
    return row[begin], begin - at[row[begin]], count, anchor - begin, tokens[anchor].view(np.int64), whole.view(np.int64)


def multikey_sort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by group and words, and the bytes that each has in common with the one before (-1: other group).

    Each pass sorts by one more word the rows that are still equal to a neighbour.
    """
    order = np.argsort(group, kind="stable")
    common = np.full(len(order), 8 * words.shape[1], np.int64)
    segment = np.cumsum(np.append(True, group[order][1:] != group[order][:-1])) if len(order) else np.zeros(0, np.int64)
    common[np.append(True, segment[1:] != segment[:-1])[: len(order)]] = -1
    active = np.arange(len(order))
    for j in range(words.shape[1]):
        # Places in a segment of more than one row.
        tied = common[active] == 8 * words.shape[1]
        after = np.append(tied[1:] & (np.diff(active) == 1), False)
        active = active[tied | after]
        if not len(active):
            break
        key = words[order[active], j]
        inner = np.lexsort((key, segment[active]))
        order[active], key = order[active][inner], key[inner]
        differs = np.append(False, (key[1:] != key[:-1]) & (segment[active][1:] == segment[active][:-1]))
        if differs.any():
            bits = np.frexp((key[1:] ^ key[:-1]).astype(np.float64))[1]
            same = np.append(0, np.clip((64 - bits) // 8, 0, 7))
            # Rounding to a double may carry into the next byte.
            shift = np.append(np.uint64(0), key[1:] ^ key[:-1]) >> (np.uint64(56) - 8 * np.minimum(same, 7).astype(np.uint64))
            same = np.where((shift == 0) & differs, same + 1, same)
            common[active[differs]] = 8 * j + same[differs]
            segment[active] += np.cumsum(differs)
            segment[active] = np.cumsum(np.append(True, (np.diff(segment[active]) != 0)))
    return order, common


def _words(raw: np.ndarray, begin: np.ndarray, step: int, size: np.ndarray, most: int) -> np.ndarray:
    """Bytes from `begin` on (backwards if step is -1) as big-endian words, zeros beyond `size`."""
    k = np.arange(most)
    place = begin[:, None] + step * k
    table = np.where(k < size[:, None], raw[np.clip(place, 0, len(raw) - 1)], 0).astype(np.uint8)
    return table.view(">u8").astype(np.uint64)


def equal_strings(raw: np.ndarray, at: np.ndarray, token: np.ndarray, count: np.ndarray, lead: np.ndarray, length: int):
    """First and last string of each suffix that also belongs to another suffix here; -1 if none does.

    `raw` and `at` hold the bytes of all strings of each suffix, `lead` how far into them it begins.
    """
    n, m = len(token), -(-(length - TOKEN + 1) // 8) * 8
    _, group = np.unique(token, return_inverse=True)
    anchor, size = at[:-1] + lead, np.diff(at)
    right, right_common = multikey_sort(_words(raw, anchor, 1, size - lead, -(-length // 8) * 8), group)
    left, left_common = multikey_sort(_words(raw, anchor - 1, -1, lead, m), group)
    low, high = np.full(n, -1), np.full(n, -1)
    for before in range(length - TOKEN, -1, -1):  # bytes of the string before the suffix
        index = lead - before
        own = (index >= 0) & (index < count)
        if own.sum() < 2:
            continue
        class_right, class_left = np.empty(n, np.int64), np.empty(n, np.int64)
        class_right[right] = np.cumsum(right_common < length - before)
        class_left[left] = np.cumsum(left_common < before)
        rows = np.flatnonzero(own)
        key = class_left[rows] * (n + 1) + class_right[rows]
        order = np.argsort(key, kind="stable")
        twin = key[order[1:]] == key[order[:-1]]
        found = rows[np.union1d(order[1:][twin], order[:-1][twin])]
        # Strings come in order of their start: the first found is the lowest.
        low[found] = np.where(low[found] < 0, index[found], low[found])
        high[found] = index[found]
    return low, high


def _texts(docs: DataFrame, text: str) -> DataFrame:
    words = text_or_empty(text)
    return docs.select(F.xxhash64(words).alias("h"), F.crc32(words.cast("binary")).alias("g"), words.alias("text"))


def _taken(texts: DataFrame, length: int) -> DataFrame:
    """All suffixes of all texts: token, strings, h, g, place (start, count and lead packed)."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in slices(batches, "text", SUFFIX_BYTES):
            row, start, count, lead, token, whole = suffixes(*flat_bytes(batch.column("text")), length)
            own = batch.select(["h", "g"]).take(pa.array(row))
            place = (start << 24) | (count << 12) | lead
            columns = [pa.array(token), pa.array(whole), own.column("h"), own.column("g"), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "strings", "h", "g", "place"])

    return texts.mapInArrow(take, "token bigint, strings bigint, h bigint, g bigint, place bigint")


def _cut_out(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted suffixes' strings, with the leading bytes that order them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, at = flat_bytes(batch.column("text"))
            lists = batch.column("wanted")
            token, strings, place = np.ascontiguousarray(lists.flatten().to_numpy().reshape(-1, 3).T)
            of = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)) // 3)
            start, count, lead = place >> 24, (place >> 12) & 0xFFF, place & 0xFFF
            begin = at[of] + start
            cuts = [raw[a:b].tobytes() for a, b in zip(begin, begin + count - 1 + length)]
            order = [int.from_bytes(x[k : k + 8], "big") - (1 << 63) for x, k in zip(cuts, lead)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(order, pa.int64()), pa.array(token), pa.array(strings), pa.array(count), pa.array(lead), pa.array(cuts, pa.binary())],
                ["leading", "token", "strings", "count", "lead", "bytes"],
            )

    per_text = wanted.groupBy("h", "g").agg(F.flatten(F.collect_list(F.array("token", "strings", "place"))).alias("wanted"))
    per_text = stored(per_text, "wanted-of-texts")
    per_text = F.broadcast(per_text) if fits(per_text) else per_text
    schema = "leading bigint, token bigint, strings bigint, count bigint, lead bigint, bytes binary"
    return texts.join(per_text, ["h", "g"]).select("text", "wanted").mapInArrow(cut, schema)


def _dealt(cuts: DataFrame) -> DataFrame:
    """One row of each different suffix, however many copies its text has, in sorted buckets."""
    once = cuts.dropDuplicates(["token", "strings"])
    return once.repartitionByRange("leading", "token").sortWithinPartitions("leading", "token")


def _in_buckets(cuts: DataFrame, length: int) -> DataFrame:
    """token, strings, low, high of the suffixes with a string that another suffix has too."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(table: pa.Table) -> pa.RecordBatch:
            token = table.column("token").to_numpy()
            strings = table.column("strings").to_numpy()
            _, once = np.unique(np.stack([token, strings]), axis=1, return_index=True)  # copies of a text
            table = table.take(pa.array(np.sort(once)))
            token, strings = token[np.sort(once)], strings[np.sort(once)]
            raw, at = flat_bytes(table.column("bytes").combine_chunks())
            low, high = equal_strings(raw, at, token, table.column("count").to_numpy(), table.column("lead").to_numpy(), length)
            some = low >= 0
            return pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (token, strings, low, high)], ["token", "strings", "low", "high"])

        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= STEP:
                table = pa.Table.from_batches(held).combine_chunks()
                token = table.column("token").to_numpy()
                changes = np.flatnonzero(token[1:] != token[:-1]) + 1
                whole = int(changes[-1]) if len(changes) else 0  # the last token may go on
                if whole:
                    yield settle(table.slice(0, whole))
                held, rows = table.slice(whole).to_batches(), table.num_rows - whole
        if rows:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    return _dealt(cuts).mapInArrow(compare, "token bigint, strings bigint, low bigint, high bigint")


def _by_digests(cuts: DataFrame, length: int) -> DataFrame:
    """As :func:`_in_buckets`, for tokens with any number of suffixes."""

    def strings_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 1 << 18):
            raw, at = flat_bytes(batch.column("bytes"))
            hashed, count = RangeHash(raw), batch.column("count").to_numpy()
            row = np.repeat(np.arange(batch.num_rows), count)
            index = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            digest = hashed(at[row] + index, at[row] + index + length)
            own = batch.select(["token", "strings"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest.view(np.int64)), own.column("token"), own.column("strings"), pa.array(index)],
                ["digest", "token", "strings", "index"],
            )

    rows = stored(cuts.dropDuplicates(["token", "strings"]).select("token", "strings", "count", "bytes"), "hot-suffixes")
    rows = rows.mapInArrow(strings_of, "digest bigint, token bigint, strings bigint, index bigint")
    twice = rows.groupBy("digest", "token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = rows.join(twice, ["digest", "token"])
    return found.groupBy("token", "strings").agg(F.min("index").alias("low"), F.max("index").alias("high"))


def repeated_spans(docs: DataFrame, *, text: str = "text", length: int = 200, most: int = MOST_SUFFIXES) -> DataFrame:
    """Per different text (h, g) with any, its removed stretches: begin, end, begin, end ... in order."""
    texts = _texts(docs, text)
    # A text that occurs twice goes whole; one copy of it stays to be compared with the others.
    size = F.octet_length("text").cast("bigint")
    copies = texts.filter(size >= length).groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("size"))
    copies = stored(copies.filter("n > 1").select("h", "g", "size"), "copies")
    keys = copies.select("h", "g")
    keys = F.broadcast(keys) if fits(keys) else keys
    # The aggregate keeps one text per key in each task, so copies do not gather.
    once = texts.join(keys, ["h", "g"], "left_semi").groupBy("h", "g").agg(F.first("text").alias("text"))
    texts = texts.join(keys, ["h", "g"], "left_anti").unionByName(stored(once, "one-copy"))
    taken = stored(_taken(texts, length), "taken")
    # Stored, so that a token with a large share of the rows can be split in the join.
    counts = stored(taken.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token"), "tokens")
    again = stored(taken.join(F.broadcast(counts) if fits(counts) else counts, "token"), "suffixes")
    kinds = again.groupBy("token", "strings").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("h", "g", "place")).alias("one"), F.min((F.shiftright("place", 12)).bitwiseAND(0xFFF)).alias("count")
    )
    kinds = stored(kinds, "kinds")
    # Tokens with different suffixes, of which one at least is not settled yet.
    open_tokens = kinds.groupBy("token").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    open_tokens = stored(open_tokens.filter("kinds > 1 and least = 1").select("token", "kinds"), "open-tokens")
    wanted = kinds.join(F.broadcast(open_tokens) if fits(open_tokens) else open_tokens, "token")
    wanted = stored(wanted.select("token", "strings", "kinds", "one.h", "one.g", "one.place"), "wanted")
    equal = _in_buckets(_cut_out(texts, wanted.filter(F.col("kinds") <= most), length), length)
    if wanted.filter(F.col("kinds") > most).limit(1).count():
        equal = equal.unionByName(_by_digests(_cut_out(texts, wanted.filter(F.col("kinds") > most), length), length))
    whole = kinds.filter("n > 1").select("token", "strings", F.lit(0).cast("bigint").alias("low"), (F.col("count") - 1).alias("high"))
    once = kinds.filter("n = 1").select("token", "strings")
    verdicts = whole.unionByName(equal.join(once, ["token", "strings"], "left_semi"))
    start = F.shiftright("place", 24)
    spans = again.join(stored(verdicts, "verdicts"), ["token", "strings"]).select(
        "h", "g", F.struct((start + F.col("low")).alias("begin"), (start + F.col("high") + length).alias("end")).alias("span")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = [_merged(x) for x in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("g"), pa.array(merged, pa.list_(pa.int64()))], ["h", "g", "spans"])

    per_text = spans.join(keys, ["h", "g"], "left_anti").groupBy("h", "g").agg(F.collect_set("span").alias("spans"))
    merged = per_text.mapInArrow(merge, "h bigint, g bigint, spans array<bigint>")
    return merged.unionByName(copies.select("h", "g", F.array(F.lit(0).cast("bigint"), F.col("size")).alias("spans")))


def _merged(spans: list[dict]) -> list[int]:
    """Overlapping or touching spans as one."""
    out: list[int] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (begin, end)
    return out


def _pairs(spans: list[int] | None) -> list[tuple[int, int]]:
    return list(zip(spans[::2], spans[1::2])) if spans else []


def _with_spans(docs: DataFrame, text: str, length: int, most: int, names: list[str]) -> DataFrame:
    spans = stored(repeated_spans(docs, text=text, length=length, most=most), "spans")
    spans = F.broadcast(spans) if fits(spans) else spans
    words = text_or_empty(text)
    keyed = docs.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)], words.alias("text_"), F.xxhash64(words).alias("h"), F.crc32(words.cast("binary")).alias("g"))
    return keyed.join(spans, ["h", "g"], "left").drop("h", "g")


def removal_report(docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = 200, most: int = MOST_SUFFIXES) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_"):
            rows = []
            for doc, words, spans in zip(*(batch.column(c).to_pylist() for c in ("c0", "text_", "spans"))):
                data, gone, kept, last = words.encode(), _pairs(spans), hashlib.sha256(), 0
                for begin, end in gone:
                    kept.update(data[last:begin])
                    last = end
                kept.update(data[last:])
                rows.append((doc, len(data), sum(e - b for b, e in gone), len(gone), kept.hexdigest()))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return _with_spans(docs, text, length, most, [id]).withColumn("c0", F.col("c0").cast("bigint")).mapInArrow(report, schema)


def without_repeats(docs: DataFrame, *, text: str = "text", length: int = 200, most: int = MOST_SUFFIXES) -> DataFrame:
    """`docs` with the repeated strings cut out of the text; a character that loses a byte goes whole."""
    names, at = docs.columns, docs.columns.index(text)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_"):
            out = []
            for original, words, spans in zip(*(batch.column(c).to_pylist() for c in (f"c{at}", "text_", "spans"))):
                if not spans:
                    out.append(original)
                    continue
                data, parts, last = words.encode(), [], 0
                for begin, end in _pairs(spans):
                    parts.append(data[last:begin])
                    last = end
                out.append(b"".join([*parts, data[last:]]).decode("utf-8", "ignore"))
            columns = [pa.array(out, pa.string()) if i == at else batch.column(f"c{i}") for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(names))])

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(f"c{i}", T.StringType() if i == at else f.dataType) for i, f in enumerate(docs.schema)])
    return _with_spans(docs, text, length, most, names).mapInArrow(remove, schema).toDF(*names)
