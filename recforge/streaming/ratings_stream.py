"""Incremental rating histogram and product statistics over a file stream.

``rating_stream`` turns a stream of lineitem parquet files into rating
events by a stream-static join with orders (the same mapping as the batch
fixtures); the aggregates keep per-key state in Spark's state store and are
emitted in complete (or update) mode.  Checkpoints go to the shared
checkpoint directory, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recforge.functions.scalar import fmt2, label
from recforge.sources.fixtures import epoch_seconds, table


def rating_stream(spark: SparkSession, lineitem_dir: str, sf_dir: str, max_files: int = 1) -> DataFrame:
    """Streaming ratings: userId, productId, rating, ts, label."""
    schema = spark.read.parquet(lineitem_dir).schema
    li = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(lineitem_dir)
          .select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    r = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("productId"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / F.lit(2.0)).alias("rating"),
        epoch_seconds(F.col("l_shipdate")).cast("long").alias("ts"),
    )
    return r.withColumn("label", label("rating"))


def running_histogram(ratings: DataFrame) -> DataFrame:
    """A1 over a stream: count per rating (shares are taken by the reader)."""
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))


def running_product_stats(ratings: DataFrame) -> DataFrame:
    """A2 over a stream: count, formatted mean and sample stddev per product."""
    return ratings.groupBy("productId").agg(
        F.count(F.lit(1)).alias("productRatingCount"),
        fmt2(F.avg("rating")).alias("productAvgRating"),
        fmt2(F.coalesce(F.stddev("rating"), F.lit(0.0))).alias("productRatingStddev"),
    )


def start_memory_sink(agg: DataFrame, name: str, checkpoint: str, mode: str = "complete"):
    """Run an aggregate into an in-process memory table (tests, notebooks)."""
    return (agg.writeStream.outputMode(mode).format("memory").queryName(name)
            .option("checkpointLocation", checkpoint).start())
