"""Labels and the rating histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recforge.functions.scalar import POSITIVE_RATING, label


def add_label(df: DataFrame, threshold: float = POSITIVE_RATING, rating: str = "rating") -> DataFrame:
    """``label`` = 1 if rating >= threshold else 0."""
    return df.withColumn("label", label(rating, threshold))


def positive_only(df: DataFrame, threshold: float = POSITIVE_RATING, rating: str = "rating") -> DataFrame:
    """Keep positive ratings (a filter Spark pushes into the scan)."""
    return df.where(F.col(rating) >= threshold)


def rating_histogram(df: DataFrame, rating: str = "rating") -> DataFrame:
    """A1: rating, count, share of all rows, ordered by rating.

    One job: the per-rating counts are partially aggregated, and the total is
    a window over the (tiny) grouped result instead of a second count job.
    """
    counts = df.groupBy(rating).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(rating, "count", (F.col("count") / total).alias("percentage")).orderBy(rating)
