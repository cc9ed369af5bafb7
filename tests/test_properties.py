"""Property checks on the fixtures and on random inputs (hypothesis)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recforge.functions.arrays import rank_by_frequency
from recforge.functions.hashing import draw, uniform_excluding
from recforge.operators import encoders as ENC
from recforge.operators import sequences as Q
from recforge.operators import splits as SP
from recforge.operators import walks as W
from recforge.plans.samples import training_samples
from recforge.sources import fixtures as fx

from .conftest import SF_SMALL


def test_transition_probs_sum_to_one(spark):
    probs = Q.transition_probs(Q.pair_counts(fx.ratings(spark, SF_SMALL), list(fx.RATING_ORDER)))
    sums = probs.groupBy("src").agg(F.sum("prob").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0


def test_walk_steps_are_edges(spark):
    pairs = Q.pair_counts(fx.ratings(spark, SF_SMALL), list(fx.RATING_ORDER))
    walks = W.random_walks(spark, pairs, n_walks=300, length=6, seed=3)
    steps = walks.select(F.explode(F.arrays_zip(F.slice("path", 1, 5).alias("a"), F.slice("path", 2, 5).alias("b"))).alias("z"))
    steps = steps.select(F.col("z.a").alias("src"), F.col("z.b").alias("dst")).where("dst IS NOT NULL")
    assert steps.join(pairs, ["src", "dst"], "left_anti").count() == 0
    assert walks.count() == 300
    assert walks.where(F.size("path") > 6).count() == 0
    again = W.random_walks(spark, pairs, n_walks=300, length=6, seed=3)
    assert sorted(map(tuple, walks.collect())) == sorted(map(tuple, again.collect()))


def test_negatives_never_equal_slot(spark):
    samples = training_samples(fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL), fx.RATING_ORDER)
    neg = SP.negative_items(samples)
    for s in (2, 3, 4, 5):
        own = F.coalesce(F.col(f"userRatedproduct{s}"), F.lit(0))
        assert neg.where(F.col(f"negtive_userRatedproduct{s}") == own).count() == 0


def test_time_split_parts_do_not_overlap(spark):
    samples = training_samples(fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL), fx.RATING_ORDER)
    for exact in (True, False):
        split = SP.time_split(samples, exact=exact)
        train_max = split.where("split = 'train'").agg(F.max("timestamp")).first()[0]
        test_min = split.where("split = 'test'").agg(F.min("timestamp")).first()[0]
        assert test_min is None or train_max < test_min


def test_multi_hot_indices_increase(spark):
    mh = ENC.multi_hot(fx.products(spark, SF_SMALL)).select(ENC.sparse_indices(F.col("vector")).alias("i"))
    for (idx,) in mh.collect():
        assert all(a < b for a, b in zip(idx, idx[1:]))


def _python_rank(words):
    counts, first = {}, {}
    for i, w in enumerate(words):
        counts[w] = counts.get(w, 0) + 1
        first.setdefault(w, i)
    return sorted(counts, key=lambda w: (-counts[w], first[w]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ABCDEFG"), max_size=12), min_size=1, max_size=8))
def test_rank_matches_python(spark, lists):
    df = spark.createDataFrame([(x,) for x in lists], "w array<string>")
    got = [r[0] for r in df.select(rank_by_frequency(F.col("w"))).collect()]
    assert got == [_python_rank(x) for x in lists]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=1100), min_size=1, max_size=20), st.integers(0, 10_000))
def test_uniform_excluding_property(spark, owns, seed):
    df = spark.createDataFrame([(i, o) for i, o in enumerate(owns)], "i long, own long")
    out = df.select("own", uniform_excluding(draw(seed, F.col("i"), F.lit(1)), F.col("own"), 1001).alias("n"))
    for own, n in out.collect():
        assert 0 <= n <= 1000 and n != own
