"""Collections on shared storage.

A collection is a folder of immutable Parquet files and a series of small version files, each the
complete list of the files that make up one version. Adding writes only the new rows. Changing and
deleting rewrites only the files that hold an affected row. A version appears when its version file
is created, which fails if that version exists already, so a failed or lost job leaves no trace in
what readers see.
"""

from __future__ import annotations

import bisect
import json
import re
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.errors import CollectionExists, CollectionNotFound, ConcurrentWrite, ValidationError
from kinfold.schema import ODD, ORDER, RECORD

FILE_BYTES = 128 * 1024 * 1024
# Bytes of an Arrow batch between Spark and an embedding function, and the setting that says so.
BATCH_BYTES, BATCH_SETTING = 4 * 1024 * 1024, "spark.sql.execution.arrow.maxBytesPerBatch"


class Folder:
    """The few file system calls needed, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(hadoop)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if it exists."""
        try:
            stream = self._fs.create(self._at(name), False)
        except Py4JJavaError as failed:
            if self._fs.exists(self._at(name)):
                return False
            raise failed
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        """Delete a folder below this one, with all it holds."""
        self._fs.delete(self._at(name), True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bound the bytes of Arrow batches for what runs inside, as texts of thousands of rows are large."""
    before = spark.conf.get(BATCH_SETTING, None)
    if before is None or int(before) <= 0 or int(before) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


@dataclass(frozen=True)
class Version:
    """One version of a collection."""

    number: int = 0
    next_batch: int = 0
    dim: int | None = None
    space: str = "l2"
    metadata: dict[str, Any] = field(default_factory=dict)
    embedder: dict[str, Any] | None = None
    promoted: dict[str, str] = field(default_factory=dict)
    files: tuple[str, ...] = ()
    #: Smallest and largest id of a file, where known.
    ranges: dict[str, list[str]] = field(default_factory=dict)
    #: The last micro-batch of each stream that this version holds.
    streams: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        fields = list(RECORD.fields)
        if self.promoted:
            fields.append(T.StructField(ODD, T.BooleanType()))
        for name, dtype in self.promoted.items():
            fields.append(T.StructField(name, T.DataType.fromDDL(dtype)))
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


class Store:
    """Reads and commits the versions of one collection."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = Folder(spark, path)
        self.path = self.folder.path

    def latest(self) -> Version:
        """The highest complete version."""
        for name in reversed(self.folder.names("versions")):
            try:
                content = json.loads(self.folder.read(f"versions/{name}"))
            except json.JSONDecodeError:  # its writer died
                continue
            return Version(**{**content, "files": tuple(content["files"])})
        raise CollectionNotFound(f"no collection at {self.path}")

    def exists(self) -> bool:
        try:
            self.latest()
        except CollectionNotFound:
            return False
        return True

    def commit(self, version: Version) -> Version:
        """Publish `version` under the next free number."""
        names = self.folder.names("versions")
        last = int(names[-1].split(".")[0]) if names else 0
        if version.number and self.latest().number != version.number:
            raise ConcurrentWrite(f"version {version.number} of {self.path} is not the latest any more")
        new = replace(version, number=last + 1)
        if not self.folder.create(f"versions/{new.number:012d}.json", json.dumps(asdict(new))):
            raise ConcurrentWrite(f"version {new.number} of {self.path} was written by someone else")
        return new

    def create(self, version: Version) -> Version:
        if self.exists():
            raise CollectionExists(f"there is a collection at {self.path}")
        return self.commit(replace(version, number=0))

    def read(self, version: Version, files: tuple[str, ...] | None = None) -> DataFrame:
        files = version.files if files is None else files
        if not files:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*files)

    def write(self, rows: DataFrame, size_hint: int | None = None) -> tuple[str, ...]:
        """Write rows as new files and return them. A known small size avoids many tiny files."""
        target = f"{self.path}/data/{uuid.uuid4().hex}"
        if size_hint is not None:
            rows = rows.coalesce(max(1, -(-size_hint // FILE_BYTES)))
        # Files in insertion order let a lookup by position skip row groups.
        writer = rows.sortWithinPartitions(*ORDER).write
        # A Bloom filter tells a lookup by id which row groups it may skip.
        writer.option("parquet.bloom.filter.enabled#id", "true").option("parquet.bloom.filter.adaptive.enabled", "true").parquet(target)
        return tuple(sorted(self.spark.read.schema(rows.schema).parquet(target).inputFiles()))

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        """`rows` written once below the collection, not part of any version, and read back. Zstandard, as it is a copy."""
        target = f"{self.path}/{name}"
        with small_batches(rows.sparkSession):
            rows.write.option("compression", "zstd").parquet(target)
        return self.spark.read.schema(rows.schema).parquet(target)

    def ranges(self, version: Version, files: tuple[str, ...]) -> dict[str, list[str]]:
        """Smallest and largest id of each file: one pass over the ids, a row per file."""
        if not files:
            return {}
        rows = self.read(version, files).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("id").alias("low"), F.max("id").alias("high"))
        held = {r["file"].rsplit("/", 1)[-1]: [r["low"], r["high"]] for r in rows.collect()}
        # A file without rows holds no id.
        return {f: held.get(f.rsplit("/", 1)[-1], ["1", "0"]) for f in files}

    def files_for(self, version: Version, ids: Iterable[str]) -> tuple[str, ...]:
        """The files that may hold one of the ids, by the ranges kept with the version."""
        wanted = sorted(str(i).encode() for i in ids)

        def may_hold(low: str, high: str) -> bool:
            at = bisect.bisect_left(wanted, low.encode())
            return at < len(wanted) and wanted[at] <= high.encode()

        return tuple(f for f in version.files if f not in version.ranges or may_hold(*version.ranges[f]))

    def touched(self, version: Version, rows: DataFrame) -> tuple[str, ...]:
        """The files that hold the given rows, a DataFrame with a `_file` column."""
        names = {r["_file"].rsplit("/", 1)[-1] for r in rows.select("_file").distinct().collect()}
        return tuple(f for f in version.files if f.rsplit("/", 1)[-1] in names)

    def with_file(self, version: Version, files: tuple[str, ...] | None = None) -> DataFrame:
        if files is not None and not files:
            return self.read(version, ()).withColumn("_file", F.lit(None).cast("string"))
        return self.read(version, files).withColumn("_file", F.col("_metadata.file_path"))


def check_name(name: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name or ""):
        raise ValidationError(f"not a collection name: {name!r}")


def json_ready(metadata: Mapping[str, Any] | None) -> dict[str, Any]:
    return json.loads(json.dumps(dict(metadata or {}), default=str))
