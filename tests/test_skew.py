"""Hot-key chunking gives exactly the plain window's results."""

import pytest
from pyspark.sql import functions as F

from recforge.operators import sequences as Q
from recforge.operators.frames import chunk_frames, key_positions
from recforge.plans.samples import training_samples
from recforge.sources import fixtures as fx

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("chunk", [7, 40])
def test_samples_chunked_equal_plain(spark, chunk):
    r, p = fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL)
    plain = training_samples(r, p, fx.RATING_ORDER, rows_per_chunk=None)
    split = training_samples(r, p, fx.RATING_ORDER, rows_per_chunk=chunk)
    assert _rows(plain) == _rows(split)


def test_pairs_and_sequences_chunked_equal_plain(spark):
    r = fx.ratings(spark, SF_SMALL)
    order = list(fx.RATING_ORDER)
    assert _rows(Q.pair_counts(r, order, rows_per_chunk=None)) == _rows(Q.pair_counts(r, order, rows_per_chunk=3))
    a = Q.item_sequences(r, order, max_len=4, rows_per_chunk=None)
    b = Q.item_sequences(r, order, max_len=4, rows_per_chunk=5)
    assert _rows(a.drop("productIds")) == _rows(b.drop("productIds"))


def test_context_copies_bounded(spark):
    r = fx.ratings(spark, SF_SMALL)
    framed = chunk_frames(r, "userId", list(fx.RATING_ORDER), preceding=3, following=2, rows_per_chunk=5)
    n = r.count()
    assert framed.where(~F.col("_ctx")).count() == n
    per_row = framed.where("_ctx").groupBy(*fx.RATING_ORDER, "userId").count()
    assert per_row.agg(F.max("count")).first()[0] <= 5


def test_positions_dense(spark):
    r = fx.ratings(spark, SF_SMALL)
    pos = key_positions(r, "userId", list(fx.RATING_ORDER), rows_per_chunk=6)
    check = pos.groupBy("userId").agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("lo"),
                                      F.max("_pos").alias("hi"), F.countDistinct("_pos").alias("d"))
    assert check.where("lo != 0 OR hi != n - 1 OR d != n").count() == 0


def test_one_time_and_null_users_are_split(spark):
    """Events that share a time are cut too, and a null user is a key like any other."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).cast("long").alias("userId"), F.lit(7).alias("ts"),
                                  F.col("id").alias("productId"))
    framed = chunk_frames(df, "userId", ["ts", "productId"], preceding=10, following=1, rows_per_chunk=100)
    sizes = framed.groupBy("userId", "_chunk").agg(F.count_if(~F.col("_ctx")).alias("n"), F.count("*").alias("all"))
    assert sizes.agg(F.max("n"), F.max("all")).first()[0] <= 100 and sizes.agg(F.max("all")).first()[0] <= 111
    assert framed.where("not _ctx").count() == 3000 and sizes.where("userId is null").count() == 10
    pos = key_positions(df, "userId", ["ts", "productId"], rows_per_chunk=100)
    assert pos.groupBy("userId").agg(F.max("_pos").alias("m"), F.countDistinct("_pos").alias("d")).where("m + 1 != d").count() == 0
    assert pos.groupBy("userId").agg(F.max("_pos").alias("m")).select(F.sum("m")).first()[0] == 2998


def test_hot_users_are_found_without_the_join(spark):
    """The counting plan reads ratings alone."""
    counted = fx.ratings(spark, SF_SMALL).select("userId")
    from recforge.operators.frames import hot_keys
    plan = counted.groupBy("userId").count()._jdf.queryExecution().toString()
    assert "part.parquet" not in plan and hot_keys(counted, "userId", 10**9).isEmpty()
