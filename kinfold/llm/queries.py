"""The operators of this package over the given tables, registered by name, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.chat import CHAT_SQL
from kinfold.llm.importance import IMPORTANCE_SQL
from kinfold.llm.mixing import MIX_SQL
from kinfold.llm.vantage import NEAREST_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, table: str, sql: str | None = None) -> Callable:
    """Register a function of one whole table."""

    def keep(build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(spark.read.parquet(f"{folder}/{table}.parquet"))
        if sql is not None:
            SQL[name] = sql
        return build

    return keep


@register("op5_shortest_pack_first", "documents")
def op5(documents: DataFrame) -> DataFrame:
    from kinfold.llm.packing import pack

    return pack(documents, size=1024, end_id=0)


@register("op6_orc_tokens", "documents")
def op6(documents: DataFrame) -> DataFrame:
    from kinfold.llm.orc_tokens import round_trip

    return round_trip(documents, end_id=2)


@register("op8_mix_sources", "documents", MIX_SQL)
def op8(documents: DataFrame) -> DataFrame:
    from kinfold.llm.mixing import mix

    return mix(documents)[1]


@register("op9_robust_outliers", "documents")
def op9(documents: DataFrame) -> DataFrame:
    from kinfold.llm.outliers import judge

    return judge(documents)


@register("op1_byte_network_language", "documents")
def op1(documents: DataFrame) -> DataFrame:
    from kinfold.llm.language import identify

    return identify(documents, sample=600)


@register("op3_weak_label_quality", "documents")
def op3(documents: DataFrame) -> DataFrame:
    from kinfold.llm.quality import classify

    return classify(documents.select("doc_id", "text")).drop("text")


@register("op10_sparse_suffix_array", "documents")
def op10(documents: DataFrame) -> DataFrame:
    from kinfold.llm.repeats import removal_report

    return removal_report(documents, length=200)


@register("op4_bag_minhash", "documents")
def op4(documents: DataFrame) -> DataFrame:
    from kinfold.llm.near_copies import near_copies

    return near_copies(documents, threshold=0.8)


@register("op2_vantage_point_trees", "embeddings", NEAREST_SQL)
def op2(embeddings: DataFrame) -> DataFrame:
    from kinfold.llm.vantage import nearest

    return nearest(embeddings, k=20, factor=1.0)


@register("op7_host_suffix_array", "pages")
def op7(pages: DataFrame) -> DataFrame:
    from kinfold.llm.pages import main_text

    return main_text(pages)


def register_many(name: str, tables: list[str], sql: str | None = None) -> Callable:
    """As :func:`register`, for a function of several whole tables."""

    def keep(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, folder: build(*[spark.read.parquet(f"{folder}/{t}.parquet") for t in tables])
        if sql is not None:
            SQL[name] = sql
        return build

    return keep


@register_many("op11_bit_sliced_importance", ["documents", "benchmark"], IMPORTANCE_SQL)
def op11(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    from kinfold.llm.importance import resample

    return resample(documents, benchmark, buckets=10_000, most_words=1, seed=2024, least_words=20, share=(10, 100))


@register("op13_prefix_target", "conversations", CHAT_SQL)
def op13(conversations: DataFrame) -> DataFrame:
    from kinfold.llm.chat import PROBE, round_trip

    rows = conversations.select("conv_id", "turn", "role", "text")
    return round_trip(rows.unionByName(rows.sparkSession.createDataFrame(PROBE, "conv_id bigint, turn bigint, role string, text string")))


@register("op12_block_convolution_runs", "documents")
def op12(documents: DataFrame) -> DataFrame:
    from kinfold.llm.periodic import digests, planted, report

    rows = documents.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    return digests(report(rows))
