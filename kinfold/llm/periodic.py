r"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, at least `least` and 2 * q words long, that no
neighbouring word extends. For periods from 2B to 4B - 1 the text is cut into blocks of B words. Such a run
repeats an aligned block of its own q words later, so the block occurs again at a distance in that range. All
distances at which a block occurs in the words that follow come from one convolution: the sum of squared
differences of block and window is zero where they agree, and an exact number-theoretic transform gives it
for all distances at once. Each zero seeds an extension to both sides, word by word. The first scale takes
blocks of three words and periods from one to seven, which is enough because runs have twelve words.

A convolution is spared where it can find nothing: a block needs every one of its words again at these distances,
and a window inside a known run of a period up to the block's length holds only multiples of that period. An
extension whose stretch lies in a run of a smaller period has not its smallest period and drops out. Sums are
taken modulo a prime, so a zero is checked word by word.

Texts are worked on in batches, one after another with a mark between them that equals no word. Words
are maximal stretches of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
Null text has no words and no runs. Whole texts are taken, of any length; memory is a small multiple
of the longest one. Repeated rows and ids are answered each. An empty table gives no rows. Columns other than id
and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import plain, slices, spread_text

#: A prime with roots of unity of order 2^27, and a generator of its units. Products stay below 2^62.
PRIME, GENERATOR = 2013265921, 31
#: Words in blocks and windows that one transform takes together.
TRANSFORM_CELLS = 1 << 19
#: Words that an extension compares at first; each further step takes twice as many.
FIRST_STEP = 32

_P = np.uint64(PRIME)


def _twiddles(size: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.ones(max(1, size // 2), np.uint64)
    done, step = 1, root
    while done < len(powers):
        more = min(done, len(powers) - done)
        powers[done : done + more] = powers[:more] * np.uint64(step) % _P
        done, step = done + more, step * step % PRIME
    return powers


def transform(x: np.ndarray) -> np.ndarray:
    """Forward transform of each row (a power of two long), results in bit-reversed order."""
    size = x.shape[1]
    powers, half = _twiddles(size, False), size // 2
    while half:
        pairs = x.reshape(len(x), -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        low = a + b
        np.subtract(low, _P, out=low, where=low >= _P)
        high = (a + (_P - b)) * powers[:: size // (2 * half)][:half] % _P
        x = np.stack([low, high], axis=2).reshape(len(x), size)
        half //= 2
    return x


def inverse_transform(x: np.ndarray) -> np.ndarray:
    """Inverse of :func:`transform`, from bit-reversed order."""
    size, half = x.shape[1], 1
    powers = _twiddles(size, True)
    while half < size:
        pairs = x.reshape(len(x), -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1] * powers[:: size // (2 * half)][:half] % _P
        low, high = a + b, a + (_P - b)
        np.subtract(low, _P, out=low, where=low >= _P)
        np.subtract(high, _P, out=high, where=high >= _P)
        x = np.stack([low, high], axis=2).reshape(len(x), size)
        half *= 2
    return x * np.uint64(pow(size, -1, PRIME)) % _P


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of (block - window)^2 modulo the prime at each offset of the block in its window (row by row)."""
    b, w = blocks.shape[1], windows.shape[1]
    offsets, size = w - b + 1, 1 << max(1, (w - 1).bit_length())
    x, y = np.zeros((len(blocks), size), np.uint64), np.zeros((len(blocks), size), np.uint64)
    x[:, :b], y[:, :w] = blocks[:, ::-1], windows
    # Wrapped-round terms land below b - 1, where no offset is read: size >= w.
    products = inverse_transform(transform(x) * transform(y) % _P)[:, b - 1 : b - 1 + offsets]
    own = (blocks * blocks % _P).sum(axis=1) % _P
    sums = np.zeros((len(blocks), w + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=sums[:, 1:])
    other = (sums[:, b:] - sums[:, :offsets]) % _P
    return (own[:, None] + other + (_P - products) * np.uint64(2)) % _P


def _recurs(code: np.ndarray, ranked: np.ndarray, n: int, low: int, high: int) -> np.ndarray:
    """Whether the word at each place occurs again from `low` to below `high` places later."""
    wanted = code * (2 * n) + np.arange(n)
    after = np.searchsorted(ranked, wanted + low)
    found = ranked[np.minimum(after, n - 1)]
    return (after < n) & (found < wanted + high)


def _stretch(words: np.ndarray, at: int, distance: int, first: int, last: int) -> tuple[int, int]:
    """The longest stretch [begin, end) of first..last round `at` in which words `distance` apart are equal."""
    step, end = FIRST_STEP, at
    while True:
        stop = min(end + step, last - distance)
        differ = words[end:stop] != words[end + distance : stop + distance]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, 2 * step
        if end >= last - distance:
            break
    step, begin = FIRST_STEP, at
    while begin > first:
        stop = max(begin - step, first)
        differ = words[stop:begin] != words[stop + distance : begin + distance]
        if differ.any():
            begin -= int(differ[::-1].argmax())
            break
        begin, step = stop, 2 * step
    return begin, end + distance


class _Runs:
    """Runs found so far in one text, by rising period; starts and ends in the batch."""

    def __init__(self) -> None:
        self.found: list[tuple[int, int, int]] = []
        self.tried: dict[int, list[tuple[int, int]]] = {}

    def seen(self, at: int, distance: int) -> bool:
        """Whether an earlier extension at this distance went over the place."""
        return any(a <= at < b for a, b in self.tried.get(distance, ())[-4:])

    def covers(self, begin: int, end: int, below: int) -> bool:
        """Whether the stretch lies in a known run of a period below the given one."""
        return any(a <= begin and end <= b and q < below for a, b, q in self.found)


def find_runs(words: np.ndarray, first: np.ndarray, least: int = 12) -> list[list[tuple[int, int, int]]]:
    """All runs (start in the text, length, period) of each text, by start and period.

    `words` numbers the words of all texts one after another, equal words alike; `first` has the place of
    each text's first word, and the end.
    """
    texts, sizes = len(first) - 1, np.diff(first)
    runs = [_Runs() for _ in range(texts)]
    # A place after each text that equals nothing keeps blocks and windows apart.
    n = len(words) + texts
    code = np.empty(n, np.int64)
    begins = first[:-1] + np.arange(texts)
    ends = begins + sizes
    inside = np.ones(n, bool)
    inside[ends] = False
    code[inside] = words
    code[ends] = (int(words.max()) + 1 if len(words) else 0) + np.arange(texts)
    owner = np.repeat(np.arange(texts), sizes + 1)
    values = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % _P
    longest = int(sizes.max(initial=0))
    block, low, high = 3, 1, 8
    while max(least, 2 * low) <= longest:
        chosen = np.flatnonzero(sizes >= max(least, 2 * low))
        for texts_here in _groups(chosen, sizes, block):
            _scale(code, values, begins, ends, owner, texts_here, runs, block, low, high, least)
        low, high = high, 2 * high
        block = low // 2
    return [sorted((a - int(begins[t]), b - a, q) for a, b, q in r.found) for t, r in enumerate(runs)]


def _groups(chosen: np.ndarray, sizes: np.ndarray, block: int) -> Iterator[np.ndarray]:
    """Texts of one scale in groups of some hundred thousand words."""
    if len(chosen):
        part = np.cumsum(sizes[chosen]) // 500_000
        yield from np.split(chosen, np.flatnonzero(np.diff(part)) + 1)


def _scale(code, values, begins, ends, owner, texts, runs, block, low, high, least) -> None:
    """Find the runs with periods from `low` to below `high` in the given texts."""
    # The words of these texts alone, each with its closing mark.
    lengths = ends[texts] - begins[texts] + 1
    local = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) + np.repeat(begins[texts] - local, lengths)
    n = len(place)
    here = np.unique(code[place], return_inverse=True)[1].astype(np.int64)
    ranked = np.sort(here * (2 * n) + np.arange(n))
    again = _recurs(here, ranked, n, low, high)
    starts = np.arange(0, n - block + 1, block)
    held = np.concatenate([[0], np.cumsum(again)])
    starts = starts[held[starts + block] - held[starts] == block]
    if not len(starts):
        return
    known = [r for t in texts for r in runs[t].found if r[2] <= block]
    if known:
        # Windows inside one run of a small period hold only its multiples.
        shift = {int(t): int(l - b) for t, l, b in zip(texts, local, begins[texts])}
        reach = np.full(n + 1, -1, np.int64)
        for a, b, _ in known:
            at = a + shift[int(owner[a])]
            reach[at] = max(reach[at], b - a + at)
        reach = np.maximum.accumulate(reach)
        text = np.searchsorted(local, starts, "right") - 1
        starts = starts[reach[starts] < np.minimum(starts + high + block, local[text] + lengths[text] - 1)]
        if not len(starts):
            return
    numbers = values[place]
    offsets = high - low
    width = offsets + block - 1
    seeds: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, TRANSFORM_CELLS // (4 * block + 8))
    # Beyond the end there is only one mark more, unlike any word.
    padded = np.concatenate([numbers, np.full(high + block, PRIME - 1, np.uint64)])
    spelled = np.concatenate([here, np.full(high + block, -1)])
    for a in range(0, len(starts), step):
        at = starts[a : a + step]
        blocks = padded[at[:, None] + np.arange(block)]
        windows = padded[at[:, None] + low + np.arange(width)]
        which, offset = np.nonzero(squared_differences(blocks, windows) == 0)
        at, distance = at[which], offset + low
        for k in range(block):  # a zero modulo the prime is not yet a match
            same = spelled[at + k] == spelled[at + distance + k]
            at, distance = at[same], distance[same]
        seeds.append((at, distance))
    at, distance = (np.concatenate(x) for x in zip(*seeds))
    order = np.lexsort((at, distance))
    for at, distance in zip(place[at[order]].tolist(), distance[order].tolist()):
        text = int(owner[at])
        mine = runs[text]
        if mine.seen(at, distance):
            continue
        begin, end = _stretch(code, at, distance, int(begins[text]), int(ends[text]))
        mine.tried.setdefault(distance, []).append((begin, end - distance))
        if end - begin >= max(least, 2 * distance) and not mine.covers(begin, end, distance):
            mine.found.append((begin, end, distance))


def repeated_words(runs: list[tuple[int, int, int]], size: int) -> np.ndarray:
    """Whether a run contains the word after that run's first period."""
    change = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:size] > 0


def report(docs: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """A row per document: its runs, the longest of them, and its text without what repeats.

    doc_id; runs (an array of start, length, period, by start and period); start, length, period of the
    longest (ties: smallest start, then period), null without runs; collapsed (the kept words, joined by one space).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [(x or "").encode().split() for x in batch.column("text").to_pylist()]
            number: dict[bytes, int] = {}
            flat = np.array([number.setdefault(w, len(number)) for some in words for w in some], np.int64)
            first = np.cumsum([0, *map(len, words)])
            found = find_runs(flat, first, least)
            best, kept = [], []
            for runs, some in zip(found, words):
                best.append(min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None))
                if runs:
                    gone = repeated_words(runs, len(some))
                    some = [w for w, g in zip(some, gone.tolist()) if not g]
                kept.append(b" ".join(some).decode())
            start, length, period = zip(*best)
            values = pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], RUNS_TYPE)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), values, *(pa.array(c, pa.int64()) for c in (start, length, period)), pa.array(kept, pa.string())],
                ["doc_id", "runs", "start", "length", "period", "collapsed"],
            )

    rows = spread_text(plain(docs, doc_id=id, text=text)).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(
        run,
        "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, start bigint, length bigint, period bigint, collapsed string",
    )


RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def digests(found: DataFrame) -> DataFrame:
    """The report with runs and text as digests: n_runs, exponent_milli, runs_sha256, collapsed_sha256."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "start",
        "length",
        "period",
        F.floor(F.col("length") * 1000 / F.col("period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def planted(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document (by CRC-32 of its id) with its words from some place on made periodic."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def change(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)).cast("bigint") + 1

        def bound(values: Column) -> Column:
            start, period = F.get(values, F.lit(0)), F.get(values, F.lit(1))
            return F.transform(words, lambda w, i: F.when(i < start, w).otherwise(F.get(words, (start + F.pmod(i - start, period)).cast("int"))))

        # One-element lists name their values, so that they are computed once.
        return F.array_join(F.get(F.transform(F.array(F.array(a, p)), bound), F.lit(0)), " ")

    split = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    changed = F.get(F.transform(F.array(split), lambda words: F.when(F.size(words) > 0, change(words)).otherwise(text)), F.lit(0))
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.isNotNull(), changed).otherwise(text)
