"""Embedding functions: text column in, vector column out.

An embedder is any object with ``embed(text: Column) -> Column`` and a JSON-able ``configuration``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions.text import is_blank, tokens
from kinfold.schema import EMBEDDING


class Embedder(Protocol):
    @property
    def configuration(self) -> dict[str, Any]: ...

    def embed(self, text: Column) -> Column: ...


class BatchEmbedder:
    """A user function from a list of texts to a list of vectors, run on Arrow batches.

    `setup`, if given, runs once per task and its result is handed to `function` as the second
    argument: the place to load a model.
    """

    def __init__(
        self,
        function: Callable[..., Sequence[Sequence[float]]],
        configuration: dict[str, Any] | None = None,
        setup: Callable[[], Any] | None = None,
    ):
        self.configuration = configuration or {"type": "batch"}
        call, prepare = function, setup

        @F.pandas_udf(EMBEDDING)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            extra = () if prepare is None else (prepare(),)
            for texts in batches:
                given = texts.notna().to_numpy()
                vectors: list[Any] = [None] * len(texts)
                made = call(texts[given].tolist(), *extra) if given.any() else []
                if len(made) != int(given.sum()):
                    raise ValueError("the embedding function must return one vector per text")
                for at, vector in zip(given.nonzero()[0], made):
                    vectors[at] = np.asarray(vector, dtype=np.float32)
                yield pd.Series(vectors, dtype=object)

        self._run = run

    def embed(self, text: Column) -> Column:
        return self._run(text)


class HashedWords:
    """Bag of words hashed into `dim` slots by relative word frequency, scaled to unit length.

    Words are split by built-in functions; Arrow batches of them go to a function that hashes each
    distinct word of a batch once and counts slots for all rows at a time. No explode and no shuffle.
    """

    def __init__(self, dim: int):
        if dim < 1:
            raise ValueError("dim must be at least 1")
        self.dim = dim
        self.configuration = {"type": "hashed_words", "dimension": dim}

        @F.arrow_udf(EMBEDDING)
        def count(words: pa.Array) -> pa.Array:
            words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
            rows, sizes = len(words), words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            coded = words.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            slot_of = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim for w in distinct], np.int64)
            slots = slot_of[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
            place = np.repeat(np.arange(rows), sizes) * dim + slots
            vectors = np.bincount(place, minlength=rows * dim).reshape(rows, dim) / np.maximum(sizes, 1)[:, None]
            length = np.sqrt(np.square(vectors).sum(axis=1, keepdims=True))
            vectors = (vectors / np.where(length > 0, length, 1.0)).astype(np.float32)
            return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * dim), pa.array(vectors.ravel()))

        self._count = count

    def embed(self, text: Column) -> Column:
        words = F.when(is_blank(text), F.array().cast("array<string>")).otherwise(tokens(text))
        # The default never shows: it tells the optimiser that there is always a vector, so that a test
        # for null is not pushed below as a second run of the function.
        return F.coalesce(self._count(words), F.lit([0.0] * self.dim).cast(EMBEDDING))


class Constant:
    """The same vector for every text."""

    def __init__(self, values: Sequence[float]):
        self.values = [float(v) for v in values]
        self.configuration = {"type": "constant", "values": self.values}

    def embed(self, text: Column) -> Column:
        return F.lit(self.values).cast(EMBEDDING)


class SeededRandom:
    """Pseudo-random components in [0, 1) drawn from the text itself, so reruns agree.

    A component is made of the first 13 hexadecimal digits of the md5 of seed, place and text.
    """

    STEPS = 1 << 52

    def __init__(self, dim: int, seed: int = 42):
        self.dim, self.seed = dim, seed
        self.configuration = {"type": "seeded_random", "dimension": dim, "seed": seed}

    def embed(self, text: Column) -> Column:
        def draw(i: Column) -> Column:
            named = F.concat(F.lit(f"{self.seed}|"), i.cast("string"), F.lit("|"), F.coalesce(text, F.lit("")))
            digits = F.substring(F.md5(named.cast("binary")), 1, 13)
            return F.conv(digits, 16, 10).cast("double") / F.lit(float(self.STEPS))

        return F.transform(F.sequence(F.lit(0), F.lit(self.dim - 1)), draw).cast(EMBEDDING)


def fill_embedding(embedding: Column, document: Column, embedder: Embedder | None) -> Column:
    """Embed where there is no vector yet and the text is not empty."""
    if embedder is None:
        return embedding
    missing = embedding.isNull() & document.isNotNull() & (document != "")
    # The text is blanked out first because a vectorised UDF sees every row, guarded or not.
    made = embedder.embed(F.when(missing, document))
    return F.when(missing, made).otherwise(embedding).cast(T.ArrayType(T.FloatType()))


#: Texts that occur in more than this share of the rows are joined back by broadcast; there are fewer than its inverse.
HOT_SHARE = 0.001


def embed_distinct(rows: DataFrame, text: str, embedder: Embedder, into: str = "embedding") -> DataFrame:
    """`rows` with the vector of their text, from one call of the embedder per different text.

    Texts are reduced by digest, in every task first. The vectors of texts that many rows share are few and
    come back by broadcast, the others by a join on the digest, so no task gets all rows of one text. A null text
    is a text of its own. For embedding functions that cost more than a shuffle of the texts.
    """
    from kinfold.operators.search import ensure_checkpoint_dir

    ensure_checkpoint_dir(rows)
    digest = F.when(F.col(text).isNotNull(), F.sha2(F.col(text).cast("binary"), 256)).otherwise(F.lit(""))
    keyed = rows.withColumn("_digest", digest)
    different = keyed.groupBy("_digest").agg(F.first(text).alias("_text"), F.count(F.lit(1)).alias("_n")).checkpoint()
    total = different.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    made = different.select("_digest", "_n", embedder.embed(F.col("_text")).alias(into)).checkpoint()
    hot = made.filter(F.col("_n") > total * HOT_SHARE).select("_digest", F.col(into).alias("_hot"), F.lit(True).alias("_is_hot"))
    rest = made.filter(F.col("_n") <= total * HOT_SHARE).select("_digest", into)
    marked = keyed.drop(into).join(F.broadcast(hot), "_digest", "left")
    many = marked.filter("_is_hot").withColumn(into, F.col("_hot"))
    few = marked.filter("_is_hot IS NULL").join(rest, "_digest", "left")
    names = [*[c for c in rows.columns if c != into], into]
    return many.select(*names).unionByName(few.select(*names))
