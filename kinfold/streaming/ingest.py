"""Continuous upsert of a stream of records into a collection."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from kinfold.collection import Collection


def latest_per_id(batch: DataFrame, order: str) -> DataFrame:
    """The newest record of every id, because a batch must not repeat an id.

    The window keeps one row per id, so Spark limits the group on the map side already and an id
    with a large share of the rows does not gather in one task.
    """
    newest = Window.partitionBy("id").orderBy(F.col(order).desc())
    return batch.withColumn("_newest", F.row_number().over(newest)).filter("_newest = 1").drop("_newest")


def upsert_stream(
    records: DataFrame,
    into: Collection,
    checkpoint: str,
    order: str = "_pos",
    event_time: str | None = None,
    delay: str = "1 hour",
) -> DataStreamWriter:
    """A stream writer that upserts every micro-batch exactly once; start it with the trigger of your choice.

    The version that a micro-batch makes records its number under the name of the checkpoint, in the same step
    that publishes its rows. A batch that is replayed, because the stream died between that and its
    own bookkeeping, finds its number and is skipped, even if newer batches of other writers came between.

    With `event_time`, further copies of a record (equal id and order) are dropped that arrive within
    `delay` of it; the state that remembers them is bounded by that watermark.
    """
    if event_time is not None:
        records = records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["id", order]).drop(event_time)
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        into.upsert(latest_per_id(batch, order), stream=(name, number))

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
