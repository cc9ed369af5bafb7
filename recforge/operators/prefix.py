"""Running sums over a whole table in which no task sees more than its range.

Rows are dealt to ranges of the order, each range is summed by itself, and the
sums of the ranges before it (a row for each range) are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE_PARTS = 64  # ranges


def prefix_sum(df: DataFrame, order: Sequence[str], value: str, out: str = "hi", parts: int = RANGE_PARTS) -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` up to and including each row in ``order`` (a total one),
    and ``_p``, its range.  Runs a job: the rows are checkpointed once dealt, so ranges stay as they are."""
    ranged = df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()).checkpoint()
    within = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_p").agg(F.sum(value).alias("_t")) \
        .select("_p", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    # A row for each range: a bound that the parameter proves.
    return ranged.withColumn("_lc", F.sum(value).over(within)).join(F.broadcast(offsets), "_p") \
        .withColumn(out, (F.col("_off") + F.col("_lc")).cast("long")).drop("_off", "_lc")
