"""The test tables as collections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.embedding import Embedder
from kinfold.functions.values import metadata_column
from kinfold.plans.sizing import spread
from kinfold.schema import as_collection

LABELS = ("lang", "source", "n_chars", "quality", "toxic")


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def vecs(self) -> DataFrame:
        """`embeddings`, with `label` promoted."""
        return as_collection(
            self["embeddings"], id="vec_id", embedding="embedding", order="vec_id", promote=["label"]
        )

    def labelled(self) -> DataFrame:
        return self["documents"].join(self["labels"], "doc_id", "left")

    @property
    def docs(self) -> DataFrame:
        """`documents` with their labels, all metadata promoted."""
        return as_collection(self.labelled(), id="doc_id", document="text", order="doc_id", promote=LABELS)

    def docs_in_map(self, names: Iterable[str] = LABELS) -> DataFrame:
        """`documents` with their labels, all metadata in the map."""
        rows = self.labelled()
        return as_collection(
            rows, id="doc_id", document="text", metadata=metadata_column(rows.schema, names), order="doc_id"
        )

    @property
    def full(self) -> DataFrame:
        """`documents` that have a vector in `embeddings`."""
        rows = self.labelled().join(self["embeddings"].drop("label"), F.col("doc_id") == F.col("vec_id"))
        return as_collection(
            rows, id="doc_id", embedding="embedding", document="text", order="doc_id", promote=LABELS
        )

    def embedded_docs(self, embedder: Embedder, promote: Iterable[str] = ("lang", "source")) -> DataFrame:
        """`documents` with a vector made from the text."""
        return as_collection(
            spread(self["documents"]),
            id="doc_id",
            embedding=embedder.embed(F.col("text")),
            document="text",
            order="doc_id",
            promote=promote,
        )

    def vector(self, vec_id: int) -> list[float]:
        """One stored vector, used as the query."""
        return self["embeddings"].filter(F.col("vec_id") == vec_id).first()["embedding"]

    def label_means(self) -> DataFrame:
        """Mean vector of every label, as query vectors (qid, embedding)."""
        parts = self["embeddings"].select("label", F.posexplode("embedding").alias("at", "x"))
        means = parts.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
        packed = F.sort_array(F.collect_list(F.struct("at", "x")))
        return means.groupBy(F.col("label").alias("qid")).agg(
            F.transform(packed, lambda p: p["x"].cast("float")).alias("embedding")
        )


def rounded(c: str | Column, name: str | None = None) -> Column:
    """A floating-point result to 6 decimals, as the checks compare it."""
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column, 6).alias(name or str(c))
