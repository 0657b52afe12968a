"""The user-facing objects: a workspace of named collections, and the collection."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import replace
from typing import Any, Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.errors import CollectionNotFound, ValidationError
from kinfold.functions.embedding import Embedder, fill_embedding
from kinfold.functions.filters import Filter, Where
from kinfold.operators import get as get_ops
from kinfold.operators import mutate, search
from kinfold.operators.facets import facets
from kinfold.operators.get import Ids
from kinfold.plans.sizing import fits
from kinfold.sources.records import Record, records_frame
from kinfold.sources.store import Store, Version, check_name, json_ready

Batch = Union[DataFrame, Record, Iterable[Record]]

# Up to this many hits a query looks its records up by position instead of joining.
MAX_LOOKUP = 1000


class Workspace:
    """Named collections under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _store(self, name: str) -> Store:
        check_name(name)
        return Store(self.spark, f"{self.root}/{name}")

    def create_collection(
        self,
        name: str,
        embedder: Embedder | None = None,
        metadata: Mapping[str, Any] | None = None,
        space: str = "l2",
        promote: Mapping[str, str] | None = None,
        get_or_create: bool = False,
    ) -> Collection:
        """Create an empty collection. `promote` maps metadata keys to SQL types to keep as columns."""
        search.check_space(space)
        store = self._store(name)
        if get_or_create and store.exists():
            return Collection(store, embedder)
        version = Version(
            space=space,
            metadata=json_ready(metadata),
            embedder=json_ready(embedder.configuration) if embedder else None,
            promoted=dict(promote or {}),
        )
        store.create(version)
        return Collection(store, embedder)

    def get_collection(self, name: str, embedder: Embedder | None = None) -> Collection:
        store = self._store(name)
        store.latest()
        return Collection(store, embedder)

    def create_or_get_collection(self, name: str, embedder: Embedder | None = None, **options: Any) -> Collection:
        return self.create_collection(name, embedder, get_or_create=True, **options)

    def get_or_create_collection(self, name: str, embedder: Embedder | None = None, **options: Any) -> Collection:
        try:
            return self.get_collection(name, embedder)
        except CollectionNotFound:
            return self.create_collection(name, embedder, get_or_create=True, **options)


class Collection:
    """Records under one path. Reads return DataFrames; writes commit a new version."""

    def __init__(self, store: Store, embedder: Embedder | None = None):
        self._store = store
        self._embedder = embedder
        self.spark = store.spark

    # ------------------------------------------------------------------ state

    @property
    def version(self) -> Version:
        return self._store.latest()

    @property
    def metadata(self) -> dict[str, Any]:
        return self.version.metadata

    @property
    def df(self) -> DataFrame:
        """The records as a DataFrame."""
        return self._store.read(self.version)

    def count(self) -> int:
        return self.df.count()

    # ------------------------------------------------------------------ writes

    @contextmanager
    def _batch(self, batch: Batch) -> Iterator[DataFrame]:
        """A batch as a stable DataFrame: vectors filled in, insertion order fixed, lineage cut.

        It lies below the collection while it is used, because it is read several times.
        """
        if isinstance(batch, Record):
            batch = [batch]
        local = not isinstance(batch, DataFrame)
        rows = records_frame(self.spark, batch) if local else batch
        if "id" not in rows.columns:
            raise ValidationError("a batch needs an id column")
        schema = self.version.schema
        rows = mutate.with_all_metadata(rows, schema).withColumn("id", F.col("id").cast("string"))
        if "embedding" in rows.columns:
            rows = rows.withColumn("embedding", F.col("embedding").cast("array<float>"))
        else:
            rows = rows.withColumn("embedding", F.lit(None).cast("array<float>"))
        # A column of nulls without a type can't be stored.
        types = {f.name: f.dataType for f in schema.fields}
        rows = rows.withColumns({f.name: F.col(f"`{f.name}`").cast(types.get(f.name, T.StringType())) for f in rows.schema if isinstance(f.dataType, T.NullType)})
        if "document" in rows.columns and self._embedder is not None:
            filled = fill_embedding(F.col("embedding"), F.col("document"), self._embedder)
            rows = rows.withColumn("embedding", filled)
        if local and self._embedder is None:
            yield rows
            return
        folder = f"batches/{uuid.uuid4().hex}"
        try:
            given = local or "_pos" in rows.columns
            # Generated numbers are safe here only because storing fixes them.
            kept = self._store.keep(rows if given else rows.withColumn("_pos", F.monotonically_increasing_id()), f"{folder}/given")
            if given and not local and not mutate.positions_serve(kept):
                # The caller's order decides, but positions are our own: none missing, none twice.
                ordered = kept.orderBy("_pos", "id").withColumn("_pos", F.monotonically_increasing_id())
                kept = self._store.keep(ordered, f"{folder}/ordered")
            yield kept
        finally:
            self._store.folder.delete(folder)

    def _publish(self, version: Version, gone: Iterable[str], new: Iterable[str], **changes: Any) -> None:
        dropped, new = set(gone), tuple(new)
        kept = tuple(f for f in version.files if f not in dropped)
        ranges = {f: r for f, r in version.ranges.items() if f not in dropped} | self._store.ranges(version, new)
        self._store.commit(replace(version, files=kept + new, ranges=ranges, **changes))

    def add(self, batch: Batch) -> None:
        """Add records; a record with a known id is left out."""
        version = self.version
        with self._batch(batch) as rows:
            facts = mutate.validate_batch(rows, version.dim)
            if not facts.rows:
                return
            small = mutate.is_small(rows, facts)
            base = self._store.read(version)
            fresh = mutate.unknown_rows(base, rows, small, not small and fits(base.select("id")))
            self._append(version, mutate.new_records(fresh, version.schema, version.next_batch), facts)

    def _append(self, version: Version, rows: DataFrame, facts: mutate.BatchFacts, **changes: Any) -> None:
        new = self._store.write(rows, facts.bytes)
        self._publish(version, (), new, dim=version.dim or facts.dim, next_batch=version.next_batch + 1, **changes)

    def _files_of(self, version: Version, batch: DataFrame, small: bool) -> tuple[str, ...]:
        if not version.files:
            return ()
        ids = batch.select("id")
        held = self._store.with_file(version).select("id", "_file")
        return self._store.touched(version, held.join(F.broadcast(ids) if small else ids, "id", "left_semi"))

    def update(self, batch: Batch) -> None:
        """Change known records; unknown ids are ignored and null fields leave the old value.

        A new text without a vector is embedded again if there is an embedding function.
        """
        version = self.version
        with self._batch(batch) as rows:
            facts = mutate.validate_batch(rows, version.dim, embedding_required=False)
            small = mutate.is_small(rows, facts)
            held = self._files_of(version, rows, small) if facts.rows else ()
            if held:
                changed = mutate.update(self._store.read(version, held), rows, small)
                self._publish(version, held, self._store.write(changed), dim=version.dim or facts.dim)

    def upsert(self, batch: Batch, stream: tuple[str, int] | None = None) -> bool:
        """Change known records and add the others.

        `stream` names a stream and the number of its micro-batch. The number is recorded in the version that the
        batch makes, in one step with its rows, and a batch whose number is recorded already is skipped (False).
        """
        version = self.version
        done = {}
        if stream is not None:
            if version.streams.get(stream[0], -1) >= stream[1]:
                return False
            done = {"streams": {**version.streams, stream[0]: stream[1]}}
        with self._batch(batch) as rows:
            facts = mutate.validate_batch(rows, version.dim)
            if not facts.rows:
                return True
            small = mutate.is_small(rows, facts)
            held = self._files_of(version, rows, small)
            if not held:
                self._append(version, mutate.new_records(rows, version.schema, version.next_batch), facts, **done)
                return True
            base = self._store.read(version, held)
            merged = mutate.upsert(base, rows, version.next_batch, small, not small and fits(base.select("id")))
            new = self._store.write(merged)
            self._publish(version, held, new, dim=version.dim or facts.dim, next_batch=version.next_batch + 1, **done)
            return True

    def delete(self, ids: Ids | str = None, where: Filter = None, where_document: Filter = None) -> None:
        """Delete the records that match all given arguments."""
        if ids is None and where is None and where_document is None:
            raise ValidationError("give at least one of ids, where and where_document")
        if isinstance(ids, str):
            ids = [ids]
        version = self.version
        if not version.files:
            return
        near = None if ids is None or isinstance(ids, DataFrame) else self._store.files_for(version, ids)
        doomed = get_ops.apply_filters(
            get_ops.restrict_ids(self._store.with_file(version, near), ids), where, where_document
        )
        held = self._store.touched(version, doomed)
        if held:
            kept = mutate.delete(self._store.read(version, held), ids, where, where_document)
            self._publish(version, held, self._store.write(kept))

    # ------------------------------------------------------------------ reads

    def get(self, ids: Ids = None, where: Filter = None, where_document: Filter = None, **options: Any) -> DataFrame:
        return get_ops.get(self._near(ids), ids, where, where_document, **options)

    def _near(self, ids: Ids) -> DataFrame:
        """The records of the files that may hold listed ids; all, if they are not listed."""
        version = self.version
        if ids is None or isinstance(ids, DataFrame):
            return self._store.read(version)
        return self._store.read(version, self._store.files_for(version, ids))

    def facets(self, keys: Iterable[str] | None = None, top: int = 10, where: Filter = None, where_document: Filter = None) -> DataFrame:
        """The most frequent values of metadata keys among the records that match."""
        return facets(get_ops.apply_filters(self.df, where, where_document), keys, top)

    def get_by_id(self, id: str, include_embedding: bool = False) -> Record | None:
        rows = get_ops.get_by_id(self._near([id]), id, include_embedding).collect()
        return Record.of_row(rows[0]) if rows else None

    def where(self, filter: Filter, limit: int = 0, offset: int = 0, include_embeddings: bool = False) -> DataFrame:
        return get_ops.where(self.df, filter, limit, offset, include_embeddings)

    def where_equals(self, field: str, value: Any, limit: int = 0, offset: int = 0, **options: Any) -> DataFrame:
        return get_ops.where_equals(self.df, field, value, limit, offset, **options)

    def query(
        self,
        vector: Sequence[float] | None = None,
        text: str | None = None,
        n_results: int = 10,
        where: Filter = None,
        where_document: Filter = None,
        **options: Any,
    ) -> DataFrame:
        """The nearest records of one vector or one text, nearest first.

        The search itself reads only vectors (and filter columns). The few records found are then
        read by their position, which skips nearly all of the stored texts and metadata.
        """
        if (vector is None) == (text is None):
            raise ValidationError("give either a vector or a text")
        version = self.version
        corpus = self._store.read(version)
        if vector is None:
            vector = search.embed_text(corpus, text, self._embedder)
        settings = dict(where=where, where_document=where_document, space=version.space, dim=version.dim, **options)
        if n_results > MAX_LOOKUP:
            return search.knn(corpus, vector, n_results, **settings)
        return search.knn_lookup(corpus, vector, n_results, **settings)

    def query_many(
        self,
        vectors: DataFrame | None = None,
        texts: DataFrame | None = None,
        n_results: int = 10,
        where: Filter = None,
        where_document: Filter = None,
        **options: Any,
    ) -> DataFrame:
        """The nearest records of many vectors (qid, embedding) or texts (qid, text)."""
        if (vectors is None) == (texts is None):
            raise ValidationError("give either vectors or texts")
        version = self.version
        if vectors is None:
            if self._embedder is None:
                raise ValidationError("cannot query by text without an embedding function")
            search.ensure_checkpoint_dir(texts, f"{self._store.path}/checkpoints")
            vectors = texts.withColumn("embedding", self._embedder.embed(F.col("text"))).checkpoint()
        return search.knn_join(
            self._store.read(version),
            vectors,
            n_results,
            where,
            where_document,
            space=version.space,
            dim=version.dim,
            lookup=MAX_LOOKUP,
            **options,
        )

    def search(self, text: str, limit: int = 10, filter: Filter = None) -> DataFrame:
        """Semantic search with an optional metadata filter."""
        return self.query(text=text, n_results=limit, where=filter)

    def search_equals(self, text: str, field: str, value: Any, limit: int = 10) -> DataFrame:
        """Semantic search over the records whose field has one value."""
        return self.search(text, limit, Where().equals(field, value))
