"""Quantiles from sketches that are kept and merged.

A sketch of a column is made for every day, or any other key, in one pass, and is a
few kilobytes whatever the number of rows.  Sketches are rows of a table: a new day
adds its row, and any range of days is merged without reading their data again.
These are Spark's own KLL sketches; with ``K`` = 400 a rank is off by
about 0.7 % of the rows at most, with high probability.

Nulls are not counted.  Of no rows there is no quantile: null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400  # size of a sketch; larger is more exact
SECONDS = 86400


def day_of(ts: Column) -> Column:
    """Days since 1970-01-01 of epoch seconds."""
    return F.floor(ts / F.lit(SECONDS)).cast("int")


def sketches(df: DataFrame, col: str, by: Column, k: int = K) -> DataFrame:
    """(day, sketch, n): a sketch of an integer column for each value of ``by``, to be written as a table."""
    return df.where(F.col(col).isNotNull()).groupBy(by.alias("day")).agg(
        F.kll_sketch_agg_bigint(F.col(col).cast("bigint"), k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged(table: DataFrame, k: int = K) -> DataFrame:
    """One row (sketch, n) of the sketches of ``table``; no rows if there is none."""
    return table.agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"), F.sum("n").alias("n")).where("n > 0")


def quantiles(table: DataFrame, ranks: Sequence[float], k: int = K) -> DataFrame:
    """(rank, value): the values of an increasing list of ranks over all sketches of ``table``."""
    listed = F.array(*(F.lit(float(r)) for r in ranks))
    pairs = F.arrays_zip(listed.alias("rank"), F.kll_sketch_get_quantile_bigint("sketch", listed).alias("value"))
    return merged(table, k).select(F.inline(pairs))


def split_point(table: DataFrame, q: float = 0.8) -> Column:
    """The value at rank ``q`` as a scalar subquery."""
    return quantiles(table, [q]).select("value").scalar()


def bucket_bounds(table: DataFrame, buckets: int = 100) -> DataFrame:
    """The inner bounds of ``buckets`` buckets of equal numbers of rows, equal bounds once."""
    return quantiles(table, [i / buckets for i in range(1, buckets)]).select("value").distinct()
