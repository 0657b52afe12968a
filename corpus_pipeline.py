"""A corpus from `documents`: rejected texts go, one of each group of near copies stays, repeated
passages are cut, sources are mixed to target weights, and what is left is packed into sequences.

Every stage but the last returns the columns of `documents`. The first three write their result to shared storage in small
batches and reread it, so that whoever takes it next doesn't move thousands of texts at once or run Python again. The mix
is a scan and a join with its sources, and packing reads it once, so no copy of its texts is kept. Ties, nulls and repeated
rows are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.mixing import mix
from kinfold.llm.near_copies import without_near_copies
from kinfold.llm.packing import pack
from kinfold.llm.quality import classify
from kinfold.llm.repeats import without_repeats
from kinfold.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the weak-label classifier keeps."""
    judged = classify(docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns}), id="in_doc_id", text="in_text")
    return stored(judged.filter("kept").select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns]), "judged")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return stored(without_near_copies(docs), "without-near-copies")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without strings of 200 bytes that occur twice; n_chars follows the text."""
    cut = without_repeats(docs, length=200)
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), count).otherwise(F.col("n_chars")))
    return stored(cut, "without-repeats")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mix(docs)[0]


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return pack(docs, size=1024, end_id=0)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("packing", packing),
]

#: Training, hashing of signatures and tokenisation can't be said in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
