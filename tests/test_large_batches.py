"""Batches beyond the broadcast bound: their rows move once, and the stored copy of a batch goes again."""

import os

from pyspark.sql import functions as F

from kinfold.functions.embedding import BatchEmbedder
from kinfold.functions.values import unpack_all
from kinfold.operators import mutate
from kinfold.sources.records import Record, records_frame
from kinfold.sources.store import BATCH_BYTES

OLD = [Record("a", [1.0, 0.0], "text a", {"x": 1, "y": "q"}), Record("b", [0.0, 1.0], "", {"x": 2}), Record("same", [4.0, 0.0], "s", {})]
NEW = [
    Record("b", [2.0, 2.0], None, {"x": "odd", "up": True}),
    Record("a", [1.5, 0.0], "", None),
    Record("c", [3.0, 3.0], "c", {"x": 7, "n": None}),
    Record("d", [5.0, 5.0], "", {}),
    Record("c", [6.0, 6.0], "again", {"x": None}),
    Record(None, [7.0, 7.0], "unnamed", {"y": "z"}),
]


def shown(df):
    return sorted(repr({k: unpack_all(v) if k == "metadata" else v for k, v in r.asDict().items()}) for r in df.drop("_odd").collect())


def collection(spark, promote):
    fields = "id string, embedding array<float>, document string, metadata map<string,struct<t:string,s:string,i:bigint,d:double,b:boolean>>"
    empty = spark.createDataFrame([], f"{fields}, _batch bigint, _pos bigint{promote}")
    return mutate.add(empty, records_frame(spark, [*OLD, Record(None, [9.0, 9.0], "old unnamed")]), 0, small=True)


def test_large_upserts_equal_update_and_add(spark):
    for promote in ("", ", x bigint", ", x bigint, _odd boolean"):
        base, batch = collection(spark, promote), records_frame(spark, NEW)
        want = shown(mutate.update(base, batch, True).unionByName(mutate.new_records(mutate.unknown_rows(base, batch, True), base.schema, 1)))
        assert len(want) == 8
        for few in (False, True):
            got = mutate.upsert(base, batch, 1, small=False, few=few)
            assert shown(got) == want
            if "_odd" in got.columns:
                assert got.filter("map_contains_key(metadata, 'x') AND _odd IS NULL").count() == 0
        assert shown(mutate.upsert(base, batch.limit(0), 1, small=False)) == shown(base)
        assert len(shown(mutate.upsert(base.limit(0), batch, 1, small=False))) == len(NEW)


def test_rows_of_a_large_batch_move_once(spark, tmp_path):
    collection(spark, "").write.parquet(f"file://{tmp_path}/base")
    records_frame(spark, NEW).write.parquet(f"file://{tmp_path}/batch")
    base, batch = (spark.read.parquet(f"file://{tmp_path}/{n}") for n in ("base", "batch"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = mutate.upsert(base, batch, 1, small=False)
        assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_batch_is_stored_in_its_order_and_goes(spark, workspace, tmp_path):
    c = workspace.create_collection("c", promote={"n": "int"})
    rows = spark.range(40).select(F.col("id").cast("string").alias("id"), F.array(F.lit(1.0)).alias("embedding"), F.col("id").cast("int").alias("n"), F.lit(None).alias("document"))
    reverse, halves, gaps = (39 - F.col("n")).cast("bigint"), (F.col("n") / 2).cast("double"), F.when(F.col("n") > 3, F.col("n") % 4).cast("bigint")
    for k, (pos, order) in enumerate([(reverse, -F.col("n")), (halves, F.col("n")), (gaps, F.struct(gaps, F.col("id")))]):
        c.add(rows.withColumn("_pos", pos).withColumn("id", F.concat(F.lit(f"{k}-"), "id")).repartition(5))
        stored = c.df.filter(F.col("_batch") == k)
        assert stored.select("_pos").distinct().count() == 40
        want = [f"{k}-{r['id']}" for r in rows.withColumn("o", order).orderBy("o").collect()]
        assert [r["id"] for r in stored.orderBy("_pos").collect()] == want
    c.upsert(rows.withColumn("_pos", reverse))
    assert c.count() == 160 and not any(os.listdir(f"{tmp_path}/c/batches"))


def test_long_texts_reach_the_function_in_bounded_batches(spark, workspace):
    def embed(texts):
        return [[float(sum(map(len, texts)))] for _ in texts]

    c = workspace.create_collection("long", BatchEmbedder(embed))
    c.add(spark.range(0, 600, 1, 1).select(F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), 40_000).alias("document"), F.col("id").alias("_pos")))
    assert max(r["embedding"][0] for r in c.df.select("embedding").collect()) <= 2 * BATCH_BYTES
