"""In-memory records as a source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from kinfold.functions.values import pack_all, unpack_all
from kinfold.schema import EMBEDDING, METADATA, RESERVED


@dataclass
class Record:
    """One record: id, optional vector, optional text, metadata (empty by default)."""

    id: str | None
    embedding: Sequence[float] | None = None
    text: str | None = None
    metadata: Mapping[str, Any] | None = field(default_factory=dict)

    @classmethod
    def of_text(cls, id: str, text: str, metadata: Mapping[str, Any] | None = None) -> Record:
        return cls(id, None, text, metadata or {})

    @classmethod
    def of_embedding(cls, id: str, embedding: Sequence[float], metadata: Mapping[str, Any] | None = None) -> Record:
        return cls(id, embedding, None, metadata or {})

    @classmethod
    def of_row(cls, row: Row) -> Record:
        """A collected result row; promoted columns become metadata keys again."""
        values = row.asDict()
        metadata = unpack_all(values.get("metadata"))
        for name, value in values.items():
            if name not in (*RESERVED, "distance", "rank", "qid") and value is not None:
                metadata[name] = value
        return cls(values["id"], values.get("embedding"), values.get("document") or "", metadata)


BATCH = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("embedding", EMBEDDING),
        T.StructField("document", T.StringType()),
        T.StructField("metadata", METADATA),
        T.StructField("_pos", T.LongType()),
    ]
)


def records_frame(spark: SparkSession, records: Iterable[Record]) -> DataFrame:
    """A list of records as a batch; the list index is the insertion order."""
    rows = [
        (
            r.id,
            None if r.embedding is None else [float(x) for x in r.embedding],
            r.text or None,
            pack_all(r.metadata),
            i,
        )
        for i, r in enumerate(records)
    ]
    return spark.createDataFrame(rows, BATCH)
