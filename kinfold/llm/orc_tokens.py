"""Token ids of documents in ORC files, in order of the document id, and back.

The files hold one row per document: integers run-length encoded in stripes, a row index and a Bloom
filter on the document id. Readers split a file by stripes, and a filter on ids skips files, stripes
and row groups by their metadata.

Null text counts as empty: such a document has the end id alone. Null document ids come first. Rows
that repeat a document id stand next to each other, in order of a hash of their texts. An empty table gives no
rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import plain, shared_folder, slices, small_batches, text_or_empty
from kinfold.llm.tokens import STEP_BYTES, default_vocabulary, encoder

FILE_SCHEMA = "doc_id bigint, start_in_file bigint, n_tokens bigint, ids array<int>"


def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end_id: int = 2,
    stripe_bytes: int = 16 << 20,
    stride: int = 1_000,
) -> None:
    """Write the ids of every whole text, each followed by `end_id`, as ORC under `path`.

    One shuffle moves the texts, before they are encoded, into ranges of the document id.
    """
    vocabulary = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, start = encoder(vocabulary, end_id), 0
        for batch in slices(batches, "text", STEP_BYTES):
            ids, at = tokens(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(start + at[:-1]), pa.array(np.diff(at)), lists],
                ["doc_id", "start_in_file", "n_tokens", "ids"],
            )
            start += int(at[-1])

    rows = plain(docs, doc_id=id, text=text).select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    # Rows that repeat an id are dealt over ranges by their texts, and equal rows anyhow.
    keyed = rows.withColumns({"tie": F.xxhash64("text"), "salt": F.rand(2)})
    rows = keyed.repartitionByRange("doc_id", "tie", "salt").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    writer = rows.mapInArrow(encode, FILE_SCHEMA).write.option("compression", "zstd")
    writer = writer.option("orc.create.index", "true").option("orc.row.index.stride", str(stride)).option("orc.stripe.size", str(stripe_bytes))
    with small_batches(docs.sparkSession):
        writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    file = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint")
    return spark.read.schema(FILE_SCHEMA).orc(path).withColumn("file", file)


def _with_start(rows: DataFrame, spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Start of each document in all files; a window orders one row per file in one task."""
    sizes = _rows(spark, path).groupBy("file").agg(F.max(F.col("start_in_file") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "file").select("doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), *columns)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files under `path`: doc_id, start (ids of all documents before it), n_tokens, ids.

    A filter on doc_id reaches the files.
    """
    return _with_start(_rows(spark, path), spark, path, "n_tokens", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_tokens`, with the count and the CRC-32 of the ids read in place of the ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat, at = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.asarray(lists.offsets)
            at = at - at[0]
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
                [*kept, "n_tokens", "ids_crc32"],
            )

    kept = ["doc_id", "start_in_file", "file"]
    schema = "doc_id bigint, start_in_file bigint, file bigint, n_tokens bigint, ids_crc32 bigint"
    found = _rows(spark, path).select(*kept, "ids").mapInArrow(digest, schema)
    return _with_start(found, spark, path, "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write `docs` and return what the files hold, a row per document."""
    path = path or f"{shared_folder(docs.sparkSession)}/orc-tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, **options)
    return read_digests(docs.sparkSession, path)
