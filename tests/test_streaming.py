"""Streaming aggregates equal their batch forms once the stream is drained."""

import os

from recforge.operators.labels import rating_histogram
from recforge.operators.products import product_rating_features
from recforge.sources import fixtures as fx
from recforge.streaming.ratings_stream import (
    rating_stream,
    running_histogram,
    running_product_stats,
    start_memory_sink,
)

from .conftest import SF_SMALL


def test_stream_matches_batch(spark, scratch):
    src = os.path.join(scratch, "lineitem")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(3).write.parquet(src)
    stream = rating_stream(spark, src, SF_SMALL)
    q1 = start_memory_sink(running_product_stats(stream), "stream_product_stats", os.path.join(scratch, "c1"))
    q2 = start_memory_sink(running_histogram(stream), "stream_histogram", os.path.join(scratch, "c2"))
    q1.processAllAvailable()
    q2.processAllAvailable()
    q1.stop()
    q2.stop()
    batch = product_rating_features(fx.ratings(spark, SF_SMALL))
    got = spark.table("stream_product_stats")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    hist = {r.rating: r["count"] for r in spark.table("stream_histogram").collect()}
    assert hist == {r.rating: r["count"] for r in rating_histogram(fx.ratings(spark, SF_SMALL)).collect()}
