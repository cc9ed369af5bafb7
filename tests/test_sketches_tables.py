"""Merged sketches against exact ranks; the table of samples by day."""

import random
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from recforge.operators import quantiles as QU
from recforge.sources import tables as TB

from .test_plans import _plan


def test_merged_sketches_have_the_ranks(spark):
    rng = random.Random(1)
    values = [int(rng.expovariate(1e-6)) for _ in range(20000)]
    df = spark.createDataFrame([(v, k % 37) for k, v in enumerate(values)] + [(None, 1), (None, 99)], "v bigint, d int")
    table = QU.sketches(df, "v", F.col("d")).checkpoint()
    assert table.count() == 37 and table.agg(F.sum("n")).first()[0] == 20000
    for r in QU.quantiles(table, [0.01, 0.25, 0.5, 0.8, 0.99]).collect():
        assert abs(sum(v <= r.value for v in values) / len(values) - r["rank"]) < 0.02
    # days kept apart and merged later say the same of a part
    early = [v for k, v in enumerate(values) if k % 37 < 10]
    mid = QU.quantiles(table.where("day < 10"), [0.5]).first().value
    assert abs(sum(v <= mid for v in early) / len(early) - 0.5) < 0.03


def test_few_values_and_none(spark):
    df = spark.createDataFrame([(v % 3, 0) for v in range(300)], "v bigint, d int")
    assert sorted(r.value for r in QU.bucket_bounds(QU.sketches(df, "v", F.col("d"))).collect()) == [0, 1, 2]
    assert QU.quantiles(QU.sketches(df.where("v > 9"), "v", F.col("d")), [0.5]).count() == 0


def samples(spark, days, label):
    return spark.createDataFrame([(u, 86400 * d + u, label) for d in days for u in range(30)], "userId bigint, timestamp bigint, label int")


def test_a_day_is_replaced_alone(spark):
    name = f"samples_{uuid.uuid4().hex}"
    TB.create_sample_table(samples(spark, [1, 2, 3], 0), name, buckets=4)
    try:
        TB.replace_days(samples(spark, [2, 5], 1).where("userId < 7"), name)
        got = {(r.day, r.label): r.n for r in spark.table(name).groupBy("day", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got == {(1, 0): 30, (2, 1): 7, (3, 0): 30, (5, 1): 7}
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_windows_by_user_need_no_exchange(spark):
    name = f"samples_{uuid.uuid4().hex}"
    TB.create_sample_table(samples(spark, [1, 2, 3], 0), name, buckets=4)
    try:
        before = Window.partitionBy("userId").orderBy("timestamp").rowsBetween(-100, -1)
        counted = spark.table(name).select("userId", "timestamp", F.count(F.lit(1)).over(before).alias("n"))
        assert "Exchange" not in _plan(counted) and "Bucketed: true" in _plan(counted)
        assert counted.agg(F.max("n")).first()[0] == 2
    finally:
        spark.sql(f"DROP TABLE {name}")
