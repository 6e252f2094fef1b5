"""Hot keys: one date holding most rows must not become one task or a wrong result."""

import glob
import os

from pyspark.sql import functions as F

from daybook.operators import joins, runlog
from daybook.sinks.files import write_partitioned


def _skewed(spark, n=300_000):
    # 2/3 of all rows on one date, the rest spread over 30 days
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 != 0, F.lit("2024-01-15")).otherwise(
            F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")), "yyyy-MM-dd")
        ).cast("date").alias("processed_date"),
        (F.col("id") * 7 % 1000).alias("v"),
    )


def test_rebalanced_write_splits_hot_date(spark, scratch):
    root = scratch("skew")
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_partitioned(_skewed(spark), root, "processed_date")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    hot = glob.glob(os.path.join(root.replace("file:", ""), "processed_date=2024-01-15", "*.parquet"))
    assert len(hot) > 1, "the hot date was written by a single task"
    assert spark.read.parquet(root).count() == 300_000


def test_join_without_broadcast_on_hot_key(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = _skewed(spark, 60_000)
        right = _skewed(spark, 3_000).select(F.col("processed_date").alias("created_at"))
        ours = joins.join_on_date(left, right, "processed_date", "created_at")
        plain = left.join(right, left.processed_date == right.created_at).select(left["*"])
        assert ours.count() == plain.count()
        assert ours.groupBy("processed_date").count().exceptAll(plain.groupBy("processed_date").count()).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_latest_per_key_hot_key(spark):
    df = _skewed(spark, 200_000).withColumn("k", (F.col("processed_date") == F.lit("2024-01-15").cast("date")).cast("int"))
    got = {r["k"]: r["id"] for r in runlog.latest_per_key(df, ["k"], ["id"]).collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("id").alias("m")).collect()}
    assert got == want
