"""Ratings, products and vectors derived from the driver's parquet tables.

The mapping is fixed (FIXTURES.md §2); the SQL oracle derives the same views
with the same arithmetic.  Only the columns a view needs are selected, so the
parquet scans read just those columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tie-breakers that make (userId, ts, productId, ...) a total order.
RATING_ORDER = ("ts", "productId", "l_orderkey", "l_linenumber", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(col: Column) -> Column:
    """Seconds since 1970-01-01 for a TIMESTAMP_NTZ column, computed from its
    calendar fields so the session time zone (and its DST) never enters."""
    days = F.unix_date(F.to_date(col)).cast("long")
    return days * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, productId, rating (0.5 .. 5.0), ts (epoch seconds) plus the
    tie-breaking line columns."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_linenumber", "l_extendedprice"
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("productId"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / F.lit(2.0)).alias("rating"),
        epoch_seconds(F.col("l_shipdate")).cast("long").alias("ts"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """productId, title ``name (YYYY)``, types (pipe-separated words)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("productId"),
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1970) + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))).alias("types"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, embedding array<float>, label."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors table keyed as an item embedding map: productId, emb."""
    return vectors(spark, sf_dir).select(F.col("vec_id").alias("productId"), F.col("embedding").alias("emb"))
