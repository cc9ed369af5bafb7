"""Training samples as a table by day, bucketed by user.

A day's samples are replaced without touching other days, and rows of a user lie
in one bucket, in the order of time: windows and joins by user read the table without an exchange.

``scratch_table`` is for operators that join one side again and again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recforge.operators.quantiles import day_of
from recforge.session import ensure_checkpoint_dir

DAY = "day"
BUCKETS = 16  # of each day; as many as the cluster has cores for a large table


def with_day(samples: DataFrame) -> DataFrame:
    """``samples`` with the day of their timestamp, the last column."""
    return samples.drop(DAY).withColumn(DAY, day_of(F.col("timestamp")))


def create_sample_table(samples: DataFrame, name: str, buckets: int = BUCKETS) -> None:
    """Save ``samples`` as a new table ``name`` by day, bucketed by userId and sorted by time.

    That an overwrite replaces only the days it has is kept as an option of the table, not of the session."""
    with_day(samples).write.format("parquet").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).bucketBy(buckets, "userId").sortBy("userId", "timestamp").saveAsTable(name)


def replace_days(samples: DataFrame, name: str) -> None:
    """Write ``samples`` into the table; the days that occur in them are replaced as a whole, all other days stay."""
    table = samples.sparkSession.table(name)
    rows = with_day(samples).select(*table.columns)
    rows.write.mode("overwrite").insertInto(name)


def scratch_table(spark: SparkSession, df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """``df`` as a new table in the checkpoint folder, bucketed by ``keys`` into the session's number of shuffle
    partitions: an equi-join by exactly these keys exchanges the other side only."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.format("parquet").option("path", f"{ensure_checkpoint_dir(spark)}/{table}") \
        .bucketBy(buckets, *keys).saveAsTable(table)
    return spark.table(table)
