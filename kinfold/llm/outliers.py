"""Quality rules: word statistics of whole texts and robust multivariate outliers among them.

Every language and source gets a minimum-covariance-determinant estimate of its transformed statistics:
starting from medians, concentration steps fit mean and covariance to the half of its rows that lies
nearest, and rows whose Mahalanobis distance to the final fit is too large are rejected. So the fit holds
while junk is less than half of a group, copies of one text included.
All rows count in every step. A step is two aggregations with partial sums in every task; quantiles come
from counts of fine classes of the distance, so nothing is sampled and a rerun gives the same fit.

Null text has no words and fails the base rules. Null language or source is a value of its own. A group
with few rows is judged by a mix, in proportion to its rows, of its own estimate and its language's; a
language with few rows keeps nearly its own center and takes spread from all rows. Repeated rows count and are judged each. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import (
    RangeHash,
    cut,
    flat_bytes,
    mixed,
    plain,
    runs_of,
    slices,
    spread_text,
    stored,
    text_or_empty,
    word_bounds,
)
from kinfold.plans.sizing import fits

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("x0", "x1", "x2", "x3", "x4")
#: Features are kept as whole multiples of 1/1024, so that sums do not depend on their order.
UNIT = 1024
#: Added to every variance: spread that is normal in any group, also where most values are equal.
LEAST_VARIANCE = 0.06
#: Median of the chi-square distribution with five degrees of freedom (fixed value).
MEDIAN_CHI2 = 4.3515


def text_counts(raw: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The base statistics of each row, from the bytes of all rows."""
    rows = len(at) - 1
    begin, end, first = word_bounds(raw, at)
    hashed = RangeHash(raw)
    hashes = hashed(begin, end)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[at[1:]] - sums[at[:-1]]

    lead = (raw & 0xC0) != 0x80
    space = np.isin(raw, np.frombuffer(b" \t\n\v\f\r", np.uint8))
    symbol = np.isin(raw, np.frombuffer(SYMBOLS, np.uint8))

    # Lines with a word that equal an earlier line of their row.
    breaks = np.flatnonzero(raw == 10)
    break_row = np.searchsorted(at, breaks, "right") - 1
    inner = breaks + 1 < at[break_row + 1]  # a line feed at the end of a row begins no line with a word
    line_begin = np.concatenate([at[:-1], breaks[inner] + 1])
    line_row = np.concatenate([np.arange(rows), break_row[inner]])
    by_place = np.argsort(line_begin, kind="stable")
    line_begin, line_row = line_begin[by_place], line_row[by_place]
    next_break = np.append(breaks, len(raw))[np.searchsorted(breaks, line_begin, "left")]
    line_end = np.minimum(next_break, at[line_row + 1])
    keep = np.searchsorted(begin, line_end) > np.searchsorted(begin, line_begin)
    line_begin, line_end, line_row = line_begin[keep], line_end[keep], line_row[keep]
    keys = mixed(hashed(line_begin, line_end) ^ mixed(line_row.astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    again = order[1:][keys[order[1:]] == keys[order[:-1]]]
    dup_lines = np.bincount(line_row[again], minlength=rows)

    # Words in runs of five words that occur twice or more in their row.
    runs, run_at = runs_of(hashes, first, 5)
    word_row = np.repeat(np.arange(rows), np.diff(first))
    keys = mixed(runs ^ mixed(word_row[run_at].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    equal = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covers = np.zeros(len(hashes) + 6, np.int64)
    np.add.at(covers, run_at[twice], 1)
    np.add.at(covers, run_at[twice] + 5, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(covers)[: len(hashes)] > 0)])
    return {
        "n_words": np.diff(first),
        "word_chars": per_row(lead & ~space),
        "n_symbols": per_row(symbol),
        "n_dup_lines": dup_lines,
        "n_repeat_words": covered[first[1:]] - covered[first[:-1]],
    }


def statistics(docs: DataFrame, *, id: str, text: str, lang: str, source: str) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text."""
    names = ["doc_id", "lang", "source"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = text_counts(*flat_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(counts[n], pa.int64()) for n in COUNTS], [*names, *COUNTS]
            )

    rows = plain(docs, doc_id=id, lang=lang, source=source, text=text).select(
        F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("source").cast("string"), text_or_empty().alias("text")
    )
    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{n} bigint" for n in COUNTS)
    return spread_text(rows).mapInArrow(count, schema)


def features() -> dict[str, Column]:
    """Length, word length, and the shares of symbols, repeated lines and repeated words, on log scales."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def share(name: str) -> Column:
        return F.log1p(10.0 * F.col(name) / words)

    # Length gets half a unit: documents of any length are welcome, freak ones less so.
    values = [
        0.25 * F.log(words.cast("double")),
        2.0 * F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        share("n_symbols"),
        share("n_dup_lines"),
        share("n_repeat_words"),
    ]
    return {n: F.round(v * UNIT).cast("bigint") for n, v in zip(FEATURES, values)}


def _distance() -> Column:
    """Squared Mahalanobis distance, from `center` and `precision` of the row's group."""
    off = [F.col(n) / float(UNIT) - F.col("center")[i] for i, n in enumerate(FEATURES)]
    p = len(FEATURES)
    terms = [off[i] * off[j] * F.col("precision")[i * p + j] for i in range(p) for j in range(p)]
    return reduce(lambda a, b: a + b, terms)


def _class(distance: Column) -> Column:
    """A fine class of a distance: 64 to each doubling."""
    return F.floor(64 * F.log2(F.greatest(distance, F.lit(1e-6)))).cast("bigint")


def _half(total: Column) -> Column:
    return 0.5 * total


def _core(total: Column) -> Column:
    """Rows that an estimate is concentrated on: as few as leave it sound, so that the most junk may lie outside."""
    return F.least(F.floor((total + len(FEATURES) + 1) / 2), total)


def _quantile(rows: DataFrame, value: str, needed: Callable[[Column], Column]) -> DataFrame:
    """Per group, the smallest value with at least `needed` of all its rows at or below it."""
    counts = rows.groupBy("grp", value).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("grp").orderBy(value)
    below = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy("grp"))
    counts = counts.withColumn("below", below).withColumn("total", total)
    return counts.filter(F.col("below") >= needed(F.col("total"))).groupBy("grp").agg(F.min(value).alias("q"))


def _with(rows: DataFrame, groups: DataFrame, columns: str = "grp") -> DataFrame:
    return rows.join(F.broadcast(groups) if fits(groups) else groups, columns)


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and inverse covariance of each group: grp, n, center, precision."""
    p = range(len(FEATURES))
    sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(FEATURES)]
    products = [
        F.sum((F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("decimal(38,0)")).cast("double").alias(f"p{i}{j}")
        for i in p for j in p if i <= j
    ]
    table = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *sums, *products)

    def invert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(FEATURES)
        for frame in frames:
            n = frame["n"].to_numpy(float)[:, None, None]
            mean = frame[[f"s{i}" for i in range(size)]].to_numpy(float) / n[:, 0] / UNIT
            second = np.stack(
                [[frame[f"p{min(i, j)}{max(i, j)}"].to_numpy(float) for j in range(size)] for i in range(size)], 0
            ).transpose(2, 0, 1) / n / UNIT**2
            spread = second - mean[:, :, None] * mean[:, None, :] + LEAST_VARIANCE * np.eye(size)
            inverse = np.linalg.inv(spread).reshape(len(frame), -1) if len(frame) else np.zeros((0, size * size))
            yield pd.DataFrame({"grp": frame["grp"], "n": frame["n"], "center": list(mean), "precision": list(inverse)})

    return table.mapInPandas(invert, "grp string, n bigint, center array<double>, precision array<double>")


def robust_fits(rows: DataFrame, *, steps: int = 3) -> DataFrame:
    """Estimates of the groups `grp` of `rows`: grp, n, center, precision, scale."""
    medians = [_quantile(rows, n, _half).withColumnRenamed("q", n) for n in FEATURES]
    center = reduce(lambda a, b: a.join(b, "grp"), medians)
    p = len(FEATURES)
    start = [float(i == j) for i in range(p) for j in range(p)]
    estimate = center.select(
        "grp",
        F.array(*[F.col(n) / float(UNIT) for n in FEATURES]).alias("center"),
        F.array(*[F.lit(x) for x in start]).alias("precision"),
    )
    estimate = cut(estimate)
    for _ in range(steps):
        measured = _with(rows, estimate).withColumn("class", _class(_distance()))
        core = cut(_quantile(measured, "class", _core))
        estimate = cut(_moments(_with(measured, core).filter(F.col("class") <= F.col("q"))))
    middle = _quantile(_with(rows, estimate).withColumn("class", _class(_distance())), "class", _half)
    # The core is too narrow; the median distance says by how much.
    scale = F.greatest(F.pow(F.lit(2.0), (F.col("q") + 0.5) / 64) / MEDIAN_CHI2, F.lit(1.0))
    return cut(estimate.join(middle.select("grp", scale.alias("scale")), "grp"))


def mixed_fits(names: DataFrame, everything, least_rows: int) -> DataFrame:
    """Estimate of each of `names` (grp, own and tongue: fits or null), mixed with those of wider groups: grp, center, precision."""
    size = len(FEATURES)

    def parts(fit) -> tuple[int, np.ndarray, np.ndarray]:
        return fit["n"], np.array(fit["center"]), np.linalg.inv(np.array(fit["precision"]).reshape(size, size)) * fit["scale"]

    _, all_center, all_spread = parts(everything)

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centers, precisions = [], []
            for own, tongue in zip(batch.column("own").to_pylist(), batch.column("tongue").to_pylist()):
                center, spread = all_center, all_spread
                if tongue:
                    n, c, s = parts(tongue)
                    # A center is known from few rows, the spread in every direction is not.
                    share = min(n / max(least_rows, 1), 1.0)
                    center, spread = (n * c + size * center) / (n + size), share * s + (1 - share) * spread
                if own:
                    n, c, s = parts(own)
                    share = min(n / max(least_rows, 1), 1.0)
                    center, spread = share * c + (1 - share) * center, share * s + (1 - share) * spread
                centers.append(center.tolist())
                precisions.append(np.linalg.inv(spread).ravel().tolist())
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("grp"), pa.array(centers, kind), pa.array(precisions, kind)], ["grp", "center", "precision"])

    return names.mapInArrow(mix, "grp string, center array<double>, precision array<double>")


def judge(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    cutoff: float = 34.0,
    least_rows: int = 200,
    steps: int = 3,
) -> DataFrame:
    """A row per document: id, counts, base_failed, distance (squared) and kept.

    `cutoff` bounds the squared distance (chance under a normal law: about two in a million); groups under `least_rows` rows are mixed with wider ones.
    """
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    own = F.to_json(F.struct(F.lit("of").alias("t"), "lang", "source"))
    rows = statistics(docs, id=id, text=text, lang=lang, source=source)
    tongue = F.to_json(F.struct(F.lit("in").alias("t"), "lang"))
    rows = rows.withColumns({"base_failed": base, "grp": own, "tongue": tongue, **features()})
    rows = stored(rows.drop("lang", "source"), "text-statistics")
    sound = rows.filter(~F.col("base_failed")).select("grp", "tongue", *FEATURES)
    tripled = sound.withColumn("grp", F.explode(F.array("grp", "tongue", F.lit("all")))).drop("tongue")
    found = robust_fits(tripled, steps=steps)
    everything = found.filter("grp = 'all'").first()
    names = rows.select("grp", F.col("tongue").alias("of_tongue")).distinct()
    if everything:
        fit = F.struct("n", "center", "precision", "scale")
        names = names.join(found.select("grp", fit.alias("own")), "grp", "left")
        names = names.join(found.select(F.col("grp").alias("of_tongue"), fit.alias("tongue")), "of_tongue", "left")
        names = mixed_fits(names.select("grp", "own", "tongue"), everything, least_rows)
    else:
        names = names.select("grp", *[F.lit(None).cast("array<double>").alias(c) for c in ("center", "precision")])
    judged = _with(rows, cut(names)).withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select(F.col("doc_id").alias(id), *COUNTS, "base_failed", "distance", kept.alias("kept"))
