"""Click models' inputs and metrics: exact slots, ids as factors, trees' leaves, areas under curves."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recforge.functions.hashing import DRAWS, draw
from recforge.operators import ctr as CTR
from recforge.operators import encoders as ENC
from recforge.operators import fields as FL

VOCAB = ["red", "blue"]


def samples(spark, rows):
    """Sample rows from (userId, productId, label, productAvgRating, userAvgRating, first type)."""
    base = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)],
                                 "userId bigint, productId bigint, label int, a double, b double, t string, k bigint")
    none = [F.lit(None).cast("long").alias(f"userRatedproduct{i}") for i in range(1, 6)]
    return base.select(
        "userId", "productId", F.when(F.col("label") == 1, 5.0).otherwise(1.0).alias("rating"), F.col("k").alias("timestamp"), "label",
        F.lit(2000).alias("releaseYear"), F.col("t").alias("productType1"), *[F.lit(None).cast("string").alias(f"productType{i}") for i in (2, 3)],
        F.lit(10).alias("productRatingCount"), F.col("a").cast("string").alias("productAvgRating"), F.lit("0.50").alias("productRatingStddev"),
        *none, F.lit(9).alias("userRatingCount"), F.lit(1999).alias("userAvgReleaseYear"), F.lit("1.00").alias("userReleaseYearStddev"),
        F.col("b").cast("string").alias("userAvgRating"), F.lit("0.10").alias("userRatingStddev"),
        *[F.lit("T").alias(f"userType{i}") for i in range(1, 6)])


def auc(model, test):
    return CTR.exact_auc(CTR.predict(model, test)).first()["auc_roc"]


def split(df):
    df = df.checkpoint()
    return df.where("timestamp % 4 != 0"), df.where("timestamp % 4 = 0")


def test_no_two_values_share_a_slot(spark):
    fields = [*FL.id_fields(), *FL.type_fields()]
    at = FL.offsets(fields)
    assert at[""] == 1001 + 30001 + 8 * 19 and at["userId"] == 1001 and at["userType5"] == at[""] - 19
    small = [*FL.id_fields(5, 7), *FL.type_fields(VOCAB)]
    rows = [(u, p, 1, 0.0, 0.0, t) for u, p, t in [(0, 0, "red"), (6, 4, "blue"), (7, 5, "green"), (-1, None, None), (None, 2, ""), (3, 1, "red")]]
    got = FL.assemble(samples(spark, rows), small, cross=False).orderBy("timestamp").select(
        ENC.vector_size(F.col("features")).alias("n"), ENC.sparse_indices(F.col("features")).alias("i")).collect()
    first, width = FL.offsets(small, 7), FL.offsets(small, 7)[""]
    assert {r.n for r in got} == {width} and width == 7 + 5 + 7 + 8 * 3
    types = lambda first_type: [first["productType1"] + first_type] + [first[f.name] + 2 for f in small[3:]]
    want = [([0], [0], 0), ([4], [6], 1), ([], [], 2), ([], [], 2), ([2], [], 2), ([1], [3], 0)]
    for r, (p, u, t) in zip(got, want):
        assert [i for i in r.i if i >= 7] == [first["productId"] + x for x in p] + [first["userId"] + x for x in u] + types(t)


def test_frequent_types(spark):
    df = samples(spark, [(1, 1, 1, 0.0, 0.0, t) for t in ["x", "x", "y", "", None, "z"]])
    assert FL.frequent_types(df, 3) == ["T", "x", "y"]


def test_machine_learns_a_pattern_of_ids(spark):
    """Like answers like: neither a user nor an item alone tells anything of the label."""
    rng = random.Random(1)
    rows = [(u, p, int(u % 2 == p % 2), 1.0, 1.0, "red") for u, p in ((rng.randrange(2000, 2040), rng.randrange(30)) for _ in range(2500))]
    train, test = split(samples(spark, rows))
    assert auc(CTR.ctr_fm(train, VOCAB, max_iter=120, step=0.05, reg=0.0, init=0.1), test) > 0.9


def test_perceptron_learns_users_and_items(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(6000):
        u, p = rng.randrange(60), rng.randrange(40)
        odds = 2.5 * (u % 3 - 1) + 2.5 * (p % 3 - 1)
        rows.append((u, p, int(rng.random() < 1 / (1 + np.exp(-odds))), 1.0, 1.0, "red"))
    train, test = split(samples(spark, rows))
    assert auc(CTR.ctr_mlp(train, VOCAB, ids=False), test) < 0.55
    assert auc(CTR.ctr_mlp(train, VOCAB), test) > 0.75


def test_factors_never_see_the_rows_they_serve(spark):
    train = samples(spark, [(k % 20, k % 15, k % 2, 1.0, 1.0, "red") for k in range(400)])
    mine, rest, users, items = CTR.id_factors(train)
    assert mine.count() + rest.count() == 400 and mine.join(rest, "timestamp").count() == 0
    alone = mine.select("userId").distinct().count()
    assert users.count() == alone and dict(users.dtypes) == {"userId": "bigint", "_userId": "array<float>"}
    unknown = CTR.predict(CTR.ctr_mlp(train, VOCAB, max_iter=2), samples(spark, [(999, 999, 1, 1.0, 1.0, "red"), (None, None, 0, 1.0, 1.0, None)]))
    assert all(0 < r.p < 1 for r in unknown.collect())


def test_leaves_learn_an_interaction(spark):
    """The label is 1 where two numbers are on the same side of 3: invisible to a linear model, plain to trees."""
    u = lambda seed: 1 + 4 * (draw(seed, F.col("timestamp")) / F.lit(float(DRAWS)))
    df = samples(spark, [(k % 50, k % 40, 0, 0.0, 0.0, "red") for k in range(4000)])
    df = df.withColumn("productAvgRating", u(1).cast("string")).withColumn("userAvgRating", u(2).cast("string"))
    same = (F.col("productAvgRating").cast("double") > 3) == (F.col("userAvgRating").cast("double") > 3)
    train, test = split(df.withColumn("label", F.when(same, 1).otherwise(0)))
    linear, trees, leaves = (auc(f(train, VOCAB), test) for f in (CTR.ctr_linear, CTR.ctr_trees, CTR.ctr_leaves))
    assert linear < 0.6 and trees > 0.9 and leaves > 0.9


def plain_areas(rows):
    pos, neg = [p for p, y in rows if y == 1], [p for p, y in rows if y == 0]
    roc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    points = [(sum(p >= t for p in pos), sum(p >= t for p, _ in rows)) for t in sorted({p for p, _ in rows}, reverse=True)]
    curve = [(tp / len(pos), tp / n) for tp, n in points]
    curve = [(0.0, curve[0][1]), *curve]
    return roc, sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))


@pytest.mark.parametrize("values", [3, 10, 100000])
def test_areas(spark, values):
    rng = random.Random(values)
    rows = [(rng.randrange(values) / values, int(rng.random() < 0.3)) for _ in range(300)]
    got = CTR.exact_auc(spark.createDataFrame([*rows, (None, 1), (0.5, None)], "p double, label int").repartition(5)).first()
    assert tuple(got) == pytest.approx(plain_areas(rows))
    one = CTR.exact_auc(spark.createDataFrame([(0.1, 1), (0.2, 1)], "p double, label int")).first()
    assert tuple(one) == (None, None) and tuple(CTR.exact_auc(spark.createDataFrame([], "p double, label int")).first()) == (None, None)
