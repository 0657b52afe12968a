"""Language identification by a small convolutional network over bytes, trained here in numpy.

A text is cut into windows of fixed length that cover all of it. Bytes are embedded, filters of several
widths slide over a window, the largest response of each filter is kept, and a softmax layer gives the
odds of each language. The odds of a text are those of its windows, weighted by their letters.

Training takes windows from at most about `sample` labelled texts per language, chosen by a hash of the
id (documented bound); prediction covers every byte of every text. A text that is null or has no
letters is `und` with score 0. Null ids are never learned from nor held out. If no text may be learned
from, every text is `und`. Repeated rows get equal answers, ties between languages go to the first in
code point order, and an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import flat_bytes, plain, slices, spread_text, text_or_empty

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Windows that one step of the network takes.
BLOCK = 512


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # (widest * EMBED) x (widths * FILTERS); narrow filters have zeros at the end
    shift: np.ndarray
    dense: np.ndarray
    bias: np.ndarray

    def hidden(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patches of embedded bytes, where each filter responds most, and how much."""
        widest, n = max(WIDTHS), len(windows)
        x = self.embed[np.pad(windows, ((0, 0), (0, widest - 1)))]
        patches = np.lib.stride_tricks.sliding_window_view(x.reshape(n, -1), widest * EMBED, axis=1)[:, ::EMBED]
        patches = np.ascontiguousarray(patches)
        response = (patches.reshape(-1, widest * EMBED) @ self.filters).reshape(n, WINDOW, -1)
        best = response.argmax(axis=1)
        return patches, best, np.take_along_axis(response, best[:, None], axis=1)[:, 0] + self.shift

    def log_odds(self, windows: np.ndarray) -> np.ndarray:
        widest, n = max(WIDTHS), len(windows)
        x = self.embed[np.pad(windows, ((0, 0), (0, widest - 1)))].reshape(n, -1)
        patches = np.lib.stride_tricks.sliding_window_view(x, widest * EMBED, axis=1)[:, ::EMBED]
        response = (patches.reshape(-1, widest * EMBED) @ self.filters).reshape(n, WINDOW, -1)
        z = np.maximum(response.max(axis=1) + self.shift, 0) @ self.dense + self.bias
        return z - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True)) - z.max(1, keepdims=True)


def windows_of(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover each row, filled up with zeros, and the row of each."""
    counts = -(-np.diff(at) // WINDOW)
    row = np.repeat(np.arange(len(counts)), counts)
    begin = at[row] + WINDOW * (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
    place = begin[:, None] + np.arange(WINDOW)
    inside = place < at[row + 1][:, None]
    return np.where(inside, raw[np.minimum(place, max(len(raw) - 1, 0))] if len(raw) else 0, 0).astype(np.uint8), row


def letters_in(windows: np.ndarray) -> np.ndarray:
    """Letters of each window, about: ASCII letters and the first bytes of other characters."""
    lower = windows | 0x20
    return (((lower >= 97) & (lower <= 122)) | (windows >= 0xC2)).sum(1)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], *, epochs: int = 6, seed: int = 5) -> Network:
    """Fit the network to windows with labels (indexes of `languages`) by Adam on cross-entropy."""
    draw = np.random.default_rng(seed)
    widest, f = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest * EMBED, f), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[: width * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
    normal = lambda *shape: draw.standard_normal(shape).astype(np.float32)
    net = Network(
        languages,
        0.5 * normal(256, EMBED),
        mask * normal(widest * EMBED, f) / np.sqrt(EMBED * 3),
        np.zeros(f, np.float32),
        normal(f, len(languages)) / np.sqrt(f),
        np.zeros(len(languages), np.float32),
    )
    names = ("embed", "filters", "shift", "dense", "bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for epoch in range(epochs):
        order, rate = draw.permutation(len(windows)), 0.004 * (1 - epoch / epochs)
        for begin in range(0, len(order), 64):
            step += 1
            some = order[begin : begin + 64]
            w, y = windows[some], labels[some]
            n = len(some)
            patches, best, response = net.hidden(w)
            active = np.maximum(response, 0)
            z = active @ net.dense + net.bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            back = (p @ net.dense.T) * (response > 0)
            chosen = patches[np.arange(n)[:, None], best]  # n x filters x patch
            to_patch = back[:, :, None] * net.filters.T[None]
            grad = {
                "dense": active.T @ p,
                "bias": p.sum(0),
                "shift": back.sum(0),
                "filters": mask * np.einsum("nf,nfk->kf", back, chosen),
                "embed": np.zeros_like(net.embed),
            }
            padded = np.pad(w, ((0, 0), (0, widest - 1)))
            for k in range(widest):
                bytes_at = padded[np.arange(n)[:, None], best + k]
                np.add.at(grad["embed"], bytes_at, to_patch[:, :, k * EMBED : (k + 1) * EMBED])
            for name in names:
                g = grad[name].astype(np.float32)
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                unbiased = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                setattr(net, name, getattr(net, name) - np.float32(rate) * unbiased[0] / (np.sqrt(unbiased[1]) + 1e-7))
    return net


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(rows: DataFrame, *, sample: int, per_text: int = 4) -> Network | None:
    """Train on windows of about `sample` texts of each language among `rows` (doc_id, text, lang)."""
    known = rows.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    rate = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, sample / n))])
    # By id and text, each different pair once: a repeated row is not drawn in bulk.
    keyed = known.withColumn("key", F.xxhash64("doc_id", "text"))
    uniform = F.pmod("key", F.lit(1 << 30)) / float(1 << 30)

    def some_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(11)
        for batch in slices(batches, "text"):
            w, row = windows_of(*flat_bytes(batch.column("text")))
            # A few windows of each text, wherever they lie.
            order = np.lexsort((draw.random(len(row)), row))
            first = np.searchsorted(row[order], row[order], "left")
            pick = order[np.arange(len(order)) - first < per_text]
            pick = pick[letters_in(w[pick]) >= 8]
            langs = batch.column("lang").take(pa.array(row[pick]))
            yield pa.RecordBatch.from_arrays([langs, pa.array([x.tobytes() for x in w[pick]], pa.binary())], ["lang", "w"])

    chosen = keyed.filter(uniform < F.element_at(rate, F.col("lang"))).dropDuplicates(["lang", "key"]).select("lang", "text")
    table = chosen.mapInArrow(some_windows, "lang string, w binary").toArrow()
    if table.num_rows == 0:
        return None
    table = table.sort_by([("lang", "ascending"), ("w", "ascending")])
    langs = table.column("lang").to_pylist()
    languages = sorted(set(langs))
    index = {lang: k for k, lang in enumerate(languages)}
    windows = np.frombuffer(b"".join(table.column("w").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([index[x] for x in langs]), languages)


def identify(docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 600) -> DataFrame:
    """A row per document: doc_id, held_out, lang_pred, score.

    Learns from documents with a known language whose crc32 of the id, modulo 4, is not 2; the others
    are held out. Neither language, source nor id is an input of a prediction.
    """
    rows = plain(docs, doc_id=id, text=text, lang=lang).select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string")
    )
    net = learn(rows, sample=sample)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, at = flat_bytes(batch.column("text"))
            n = batch.num_rows
            total, weight = np.zeros((n, len(net.languages) if net else 1)), np.zeros(n)
            if net:
                w, row = windows_of(raw, at)
                for begin in range(0, len(w), BLOCK):
                    some, of = w[begin : begin + BLOCK], row[begin : begin + BLOCK]
                    share = letters_in(some) + 0.001
                    odds = np.maximum(net.log_odds(some), -8) * share[:, None]
                    np.add.at(total, of, odds)
                    np.add.at(weight, of, share)
            mean = total / np.maximum(weight, 1e-9)[:, None]
            p = np.exp(mean - mean.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            # Letters only: a fraction or a raised digit is none.
            has = np.array([any(map(str.isalpha, t)) for t in batch.column("text").to_pylist()], bool) & (net is not None)
            names = [net.languages[b] if h else "und" for b, h in zip(best, has)]
            score = np.round(np.where(has, p[np.arange(n), best], 0.0), 6)  # alike wherever a text lies in its batch
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    inputs = spread_text(rows.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text")))
    return inputs.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")
