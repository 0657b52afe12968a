"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on the statistics of a whole text. Expectation-maximisation
over the counts of vote patterns, of which there are at most 3 ** labellers whatever the corpus, estimates
how often each labeller is right, and so the chance that a text with a given pattern is good. These
posterior labels train a linear scorer on hashed word and shape features, which judges every text.

All texts count in the estimates. The scorer learns from about `sample` texts (documented bound), chosen
by a hash of the id and evenly over patterns of either side. Null text counts as empty; a text without
words has score 0 and is not kept. Repeated rows get equal answers. An empty table gives no rows. If no
labeller tells the texts apart, the posterior is the score. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import (
    RangeHash,
    flat_bytes,
    forget_words,
    mixed,
    plain,
    slices,
    small_batches,
    spread_text,
    text_or_empty,
    word_bounds,
)

BUCKETS = 1 << 15
#: Text bytes judged in one step, whose features take some 40 MB.
JUDGED_BYTES = 1 << 18

#: Labeller, statistic, bad from this value on, good up to this value, least words to vote. They overlap.
LABELLERS = (
    ("symbols", "symbol_share", 0.20, 0.03, 1),
    ("capitals", "capital_share", 0.45, 0.15, 1),
    ("exclamations", "exclaim_share", 0.25, 0.05, 1),
    ("repeated words", "again_share", 0.20, 0.04, 1),
    ("table bars", "bar_share", 0.15, 0.02, 1),
    ("few different words", "sameness", 0.80, 0.65, 40),
    ("hardly any plain words", "odd_share", 0.40, 0.15, 8),
    ("repeats or odd words", "trouble", 0.35, 0.20, 5),
)


def class_of_byte() -> np.ndarray:
    """Shape class of each byte: lower case, upper case, digit, other letter, or the sign itself."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 1, 2, 3, 1
    return table


class Features:
    """Statistics and hashed features of each row of a batch."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        rows = len(at) - 1
        begin, end, first = word_bounds(raw, at)
        self.words = np.diff(first)
        word_row = np.repeat(np.arange(rows), self.words)
        many = np.maximum(self.words, 1)
        hashes = RangeHash(raw)(begin, end)

        def per_row(flags: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            return sums[at[1:]] - sums[at[:-1]]

        again = np.zeros(len(hashes), bool)
        if len(hashes):
            again[1:] = (hashes[1:] == hashes[:-1]) & (word_row[1:] == word_row[:-1])
        upper, lower = per_row((raw >= 65) & (raw <= 90)), per_row((raw >= 97) & (raw <= 122))
        keys = mixed(hashes ^ mixed(word_row.astype(np.uint64)))
        different = np.bincount(np.searchsorted(at, begin[np.unique(keys, return_index=True)[1]], "right") - 1, minlength=rows)
        self.symbol_share = per_row(np.isin(raw, np.frombuffer(b"#*$%&<>", np.uint8))) / many
        self.capital_share = upper / np.maximum(upper + lower, 1)
        self.exclaim_share = per_row(raw == 33) / many
        self.bar_share = per_row(raw == 124) / many
        self.again_share = np.bincount(word_row[again], minlength=rows) / many
        # Long texts repeat common words: compare with what a text of that length has.
        self.sameness = 1 - different / np.maximum(np.minimum(many, 20 * np.sqrt(many)), 1)
        # A plain word is letters and at most one other sign, not mostly capitals.
        letter = np.concatenate([[0], np.cumsum(class_of_byte()[raw] <= 2, dtype=np.int64)])
        capital = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90), dtype=np.int64)])
        letters, capitals = letter[end] - letter[begin], capital[end] - capital[begin]
        odd = (end - begin - letters > 1) | (letters == 0) | (capitals > np.maximum(1, letters // 2))
        self.odd_share = np.bincount(word_row[odd], minlength=rows) / many
        self.trouble = np.bincount(word_row[odd | again], minlength=rows) / many

        # Shapes: runs of one class count once.
        shape = class_of_byte()[raw]
        starts = np.zeros(len(raw), bool)
        starts[begin] = True
        change = starts.copy()
        change[1:] |= shape[1:] != shape[:-1]
        place = np.concatenate([[0], np.cumsum(change)])
        kept = shape[change]
        shapes = RangeHash(kept)(place[begin], place[end]) if len(begin) else np.zeros(0, np.uint64)
        pair = np.zeros(len(shapes), np.uint64)
        if len(shapes):
            pair[1:] = mixed(shapes[1:] * np.uint64(3) ^ shapes[:-1] ^ again[1:].astype(np.uint64))
        self.codes = [mixed(hashes) % np.uint64(BUCKETS), shapes % np.uint64(BUCKETS), pair % np.uint64(BUCKETS)]
        # A few words say little: their features count as if some neutral words stood beside them.
        self.row, self.many = word_row, many + 4

    def votes(self) -> np.ndarray:
        """-1, 0 or 1 of each labeller for each row."""
        out = np.zeros((len(self.words), len(LABELLERS)), np.int8)
        for k, (_, name, bad, good, least) in enumerate(LABELLERS):
            value = getattr(self, name)
            out[:, k] = np.where(self.words < least, 0, np.where(value >= bad, -1, np.where(value <= good, 1, 0)))
        out[self.words == 0] = -1
        return out

    def linear(self, weights: np.ndarray) -> np.ndarray:
        """Mean weight of a row's features of each kind, summed."""
        total = np.zeros(len(self.words))
        for kind, code in enumerate(self.codes):
            total += np.bincount(self.row, weights[kind * BUCKETS + code.astype(np.int64)], minlength=len(self.words))
        return total / self.many


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return ((votes.astype(np.int64) + 1) * 3 ** np.arange(votes.shape[1])).sum(1)


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1).astype(np.int8)


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior chance of good per pattern, how often each labeller gives each vote, and the share of good.

    The second result, labeller x (bad, good text) x (bad, good vote), holds a labeller's accuracy on
    either side, among the texts on which it votes: kinds of bad text exclude each other, so a labeller sees few of them but is seldom
    wrong when it objects. The start, where one objection makes a text suspect, settles which side is
    good; a prior of a few texts keeps chances off 0 and 1.
    """
    weight = counts / max(counts.sum(), 1)
    is_vote = np.stack([votes == v for v in (-1, 1)], 2).astype(float)  # pattern x labeller x vote
    good = np.where((votes == -1).any(1), 0.1, 0.95)
    prior = np.array([[0.3, 0.7], [0.01, 0.99]]) * 0.002
    given, share = np.zeros((votes.shape[1], 2, 2)), 0.5
    for _ in range(rounds):
        share = float(np.clip((weight * good).sum(), 0.02, 0.98))
        for y, part in enumerate((1 - good, good)):
            given[:, y] = np.einsum("p,pkv->kv", weight * part, is_vote) + prior[y]
        given /= given.sum(2, keepdims=True)
        logs = np.einsum("pkv,kyv->py", is_vote, np.log(given))
        good = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1] + np.log((1 - share) / share), -60, 60)))
    return good, given, share


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], *, epochs: int = 5, seed: int = 3) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse features (codes, values, target) by Adagrad."""
    weights, sums, draw = np.zeros(3 * BUCKETS), np.full(3 * BUCKETS, 1e-6), np.random.default_rng(seed)
    bias = 1.0  # a text about which nothing is known is fine
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            codes, values, target = rows[k]
            error = 1 / (1 + np.exp(-np.clip(weights[codes] @ values + bias, -30, 30))) - target
            step = error * values
            sums[codes] += step * step
            weights[codes] -= 0.5 * step / np.sqrt(sums[codes])
    return weights, bias


def classify(docs: DataFrame, *, id: str = "doc_id", text: str = "text", sample: int = 1_500, threshold: float = 0.3) -> DataFrame:
    """The documents with score (0 to 1), weak_label (the posterior) and kept, in columns of those names.

    `docs` keeps its other columns; those that clash with the three are replaced.
    """
    thin = plain(docs, doc_id=id, text=text).select(F.col("doc_id").cast("string"), text_or_empty().alias("text"))

    def count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        seen = np.zeros(3 ** len(LABELLERS), np.int64)
        for batch in slices(batches, "text", JUDGED_BYTES):
            seen += np.bincount(pattern_of(Features(*flat_bytes(batch.column("text"))).votes()), minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["pattern", "n"])

    partial = spread_text(thin.select("text")).mapInArrow(count_patterns, "pattern bigint, n bigint")
    with small_batches(docs.sparkSession):
        table = partial.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
    patterns, counts = table["pattern"].to_numpy(np.int64), table["n"].to_numpy(np.int64)
    good, _, _ = estimate(votes_of(patterns), counts.astype(float))
    posterior = np.zeros(3 ** len(LABELLERS))
    posterior[patterns] = good
    side = [max(int(counts[good < 0.5].sum()), 1), max(int(counts[good >= 0.5].sum()), 1)]
    rates = [min(1.0, sample / n) for n in side]

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in slices(batches, "text", JUDGED_BYTES):
            found = Features(*flat_bytes(batch.column("text")))
            label = posterior[pattern_of(found.votes())]
            take = (batch.column("u").to_numpy() < np.where(label < 0.5, *rates)) & (found.words > 0)
            edges = np.searchsorted(found.row, np.arange(batch.num_rows + 1))
            keys, out = batch.column("key").to_numpy(), []
            for k in np.flatnonzero(take):
                own = slice(edges[k], edges[k + 1])
                codes = np.concatenate([c[own].astype(np.int64) + kind * BUCKETS for kind, c in enumerate(found.codes)])
                codes, n = np.unique(codes, return_counts=True)
                out.append((int(keys[k]), codes.astype("<i4").tobytes(), (n / found.many[k]).astype("<f4").tobytes(), float(label[k])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "codes", "parts", "label"])

    # By id and text, each different pair once: neither null ids nor a repeated row are drawn in bulk.
    key = F.xxhash64("doc_id", "text")
    keyed = thin.withColumn("key", key).withColumn("u", F.pmod("key", F.lit(1 << 30)) / float(1 << 30))
    drawn = spread_text(keyed.filter(F.col("u") < max(rates)))
    with small_batches(docs.sparkSession):
        taught = drawn.mapInArrow(examples, "key bigint, codes binary, parts binary, label double").dropDuplicates(["key"]).toArrow().to_pylist()
    taught.sort(key=lambda r: (r["codes"], r["parts"]))
    rows = [(np.frombuffer(r["codes"], "<i4"), np.frombuffer(r["parts"], "<f4").astype(float), r["label"]) for r in taught]
    both = any(r[2] < 0.5 for r in rows) and any(r[2] >= 0.5 for r in rows)
    weights, bias = fit_scorer(rows) if both else (None, 0.0)
    if weights is not None:
        weights = weights.astype(np.float32)

    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in slices(batches, judged_text, JUDGED_BYTES):
            found = Features(*flat_bytes(batch.column(judged_text)))
            label = posterior[pattern_of(found.votes())]
            value = label if weights is None else 1 / (1 + np.exp(-np.clip(found.linear(weights) + bias, -30, 30)))
            value = np.where(found.words > 0, value, 0.0)
            kept = value >= threshold
            own = {"score": pa.array(value), "weak_label": pa.array(label), "kept": pa.array(kept)}
            columns = [batch.column(f"c{i}") for i in range(len(names)) if names[i] not in own]
            yield pa.RecordBatch.from_arrays([*columns, *own.values()], out_names)

    rest = [(i, n) for i, n in enumerate(names) if n not in ("score", "weak_label", "kept")]
    out_names = [*[f"c{i}" for i, _ in rest], "score", "weak_label", "kept"]
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    from pyspark.sql import types as T

    judged_text = f"c{names.index(text)}"
    if not isinstance(docs.schema[names.index(text)].dataType, T.StringType):  # else texts would travel twice
        numbered, judged_text = numbered.withColumn("_text_", text_or_empty(judged_text)), "_text_"
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[i].dataType) for i, _ in rest])
    schema = schema.add("score", "double").add("weak_label", "double").add("kept", "boolean")
    judged = spread_text(numbered).mapInArrow(score, schema)
    return judged.toDF(*[n for _, n in rest], "score", "weak_label", "kept")
