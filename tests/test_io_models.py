"""Round trips of the file formats and invariants of the model jobs."""

import math

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from recforge.functions.hashing import DRAWS, draw
from recforge.operators import als as AL
from recforge.operators import ctr as CTR
from recforge.operators import embeddings as E
from recforge.operators import fields as FL
from recforge.operators import item2vec as I2V
from recforge.plans.samples import save_train_test, training_samples
from recforge.sources import files as IO
from recforge.sources import fixtures as fx

from .conftest import SF_SMALL


def test_ratings_csv_round_trip(spark, scratch):
    r = fx.ratings(spark, SF_SMALL).select("userId", "productId", "rating", F.col("ts").alias("timestamp"))
    IO.write_samples(r, scratch + "/ratings", single_file=True)
    back = IO.read_ratings(spark, scratch + "/ratings")
    assert back.count() == r.count()
    assert dict(back.dtypes) == {"userId": "bigint", "productId": "bigint", "rating": "double", "ts": "bigint"}


def test_bad_values_become_null(spark, scratch):
    path = scratch + "/bad.csv"
    with open(path, "w") as f:
        f.write("userId,productId,rating,timestamp\n1,2,x,10\n3,4,4.5,11\n")
    rows = IO.read_ratings(spark, path).orderBy("userId").collect()
    assert rows[0]["rating"] is None and rows[1]["rating"] == 4.5


def test_samples_csv_read_back(spark, scratch):
    s = training_samples(fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL), fx.RATING_ORDER)
    IO.write_samples(s, scratch + "/samples")
    back = IO.read_samples(spark, scratch + "/samples")
    assert len(back.collect()) == s.count()
    assert back.where(F.col("userRatedproduct5").isNull()).count() == 0
    assert IO.malformed_samples(spark, scratch + "/samples").first().kept == s.count()


def test_thousands_separators_survive(spark, scratch):
    s = training_samples(fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL), fx.RATING_ORDER).limit(10)
    IO.write_samples(s.withColumn("productAvgRating", F.lit("1,234.50")), scratch + "/comma")
    rows = IO.read_samples(spark, scratch + "/comma").collect()
    assert len(rows) == 10 and all(r.productAvgRating == 1234.5 for r in rows)


def test_malformed_rows(spark, scratch):
    """Short, long and unreadable rows are skipped and counted, or kept if asked; empty fields are not malformed."""
    names = [f.name for f in IO.SAMPLE_SCHEMA.fields]
    good = ["1", "2", "4.5", "99", "1", "2000", "a", "b", "", "3", "1,234.50", "", *["7"] * 5, "5", "1999", "1.0", "2.0", "0", "x", "", "", "", "0"]
    assert len(good) == len(names)
    line = lambda fields: ",".join(f'"{x}"' if "," in x else x for x in fields)
    oops = [*good[:10], "oops", *good[11:]]
    with open(scratch + "/odd.csv", "w") as f:
        f.write("\n".join(map(line, [names, good, good[:-3], [*good, "more"], oops, good, ["1"]])) + "\n")
    rows = IO.read_samples(spark, scratch + "/odd.csv").collect()
    assert len(rows) == 2 and all((r.productAvgRating, r.productRatingStddev, r.userType2, r.productType3) == (1234.5, 0.0, "", "") for r in rows)
    assert tuple(IO.malformed_samples(spark, scratch + "/odd.csv").first()) == (6, 3, 1, 2)
    kept = IO.read_samples(spark, scratch + "/odd.csv", skip_malformed=False).collect()
    assert len(kept) == 6 and sorted(r.productAvgRating for r in kept) == [0.0, 0.0, 1234.5, 1234.5, 1234.5, 1234.5]


def test_save_train_test(spark, scratch):
    s = training_samples(fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL), fx.RATING_ORDER)
    for by_time in (False, True):
        paths = save_train_test(s, f"{scratch}/{by_time}", fraction=0.5, by_time=by_time)
        train, test = (IO.read_samples(spark, paths[p]) for p in ("train", "test"))
        assert train.count() > 2 * test.count() > 0
        if by_time:
            assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]


def test_embeddings_text_round_trip(spark, scratch):
    emb = fx.item_vectors(spark, SF_SMALL)
    IO.write_embeddings(emb, scratch + "/emb")
    back = IO.read_embeddings(spark, scratch + "/emb")
    a = {r.productId: r.emb for r in emb.collect()}
    b = {int(r.productId): r.emb for r in back.collect()}
    assert a.keys() == b.keys()
    k = next(iter(a))
    assert all(math.isclose(x, y, rel_tol=1e-6) for x, y in zip(a[k], b[k]))


def test_als_topk_and_model_round_trip(spark, scratch):
    train, test = AL.train_test(fx.ratings(spark, SF_SMALL))
    model = AL.fit_als(train)
    recs = AL.user_recs(model, 10)
    per_user = recs.groupBy("userIdInt").agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("rank", "rating")).alias("r"))
    for row in per_user.collect():
        assert row.n <= 10
        ratings = [x.rating for x in sorted(row.r)]
        assert ratings == sorted(ratings, reverse=True)
    IO.save_model(model, scratch + "/als")
    again = IO.load_model(ALSModel, scratch + "/als")
    assert again.userFactors.count() == model.userFactors.count()
    rm = AL.rmse(model.transform(test)).first()
    assert rm.n > 0 and math.isfinite(rm.rmse)


def test_item2vec_and_lsh(spark):
    from recforge.operators import sequences as Q

    model = I2V.item2vec(Q.item_sequences(fx.ratings(spark, SF_SMALL), list(fx.RATING_ORDER)), min_count=1)
    emb = I2V.embeddings_from_model(model)
    assert emb.where(F.size("emb") != 10).count() == 0
    lsh, vec = I2V.lsh_model(fx.item_vectors(spark, SF_SMALL), bucket_length=4.0)
    key = fx.item_vectors(spark, SF_SMALL).where("productId = 0").first()["emb"]
    approx = {r.productId for r in I2V.approx_neighbours(lsh, vec, [float(x) for x in key], 6).collect()} - {0}
    exact = {r.vec_id for r in E.nearest_k(fx.vectors(spark, SF_SMALL), E.query_vector(fx.vectors(spark, SF_SMALL), 0), 6).collect()} - {0}
    assert len(approx & exact) / 5 >= 0.4  # the key itself doesn't count


def test_absent_id_and_zero_vector(spark):
    import pytest

    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="no vector with id 9"):
        E.nearest_k(vectors, E.query_vector(vectors, 9)).collect()
    assert [r.vec_id for r in E.most_similar(vectors, 1).collect()] == [3]


def planted_samples(spark, n=4000):
    """Samples whose label follows the product's mean rating and the first types."""
    k = F.col("id")
    u = (draw(0, k) / F.lit(float(DRAWS)))
    odds = 3.0 * (u - 0.5) + F.when(k % 3 == 0, 1.5).otherwise(-0.8)
    return spark.range(n).select(
        (k % 50).alias("userId"), (k % 40).alias("productId"), F.lit(1).cast("double").alias("rating"), k.alias("timestamp"),
        F.when(draw(1, k) / F.lit(float(DRAWS)) < 1 / (1 + F.exp(-odds)), 1).otherwise(0).alias("label"),
        F.lit(2000).alias("releaseYear"), *[F.when(k % 3 == 0, f"A{i}").otherwise(f"B{i}").alias(f"productType{i}") for i in (1, 2, 3)],
        F.lit(1200).alias("productRatingCount"), F.format_number(1000 + 10 * u, 2).alias("productAvgRating"), F.lit("0.50").alias("productRatingStddev"),
        *[F.lit(None).cast("long").alias(f"userRatedproduct{i}") for i in range(1, 6)], F.lit(9).alias("userRatingCount"),
        F.lit(1999).alias("userAvgReleaseYear"), F.lit("1.00").alias("userReleaseYearStddev"), F.lit("3.00").alias("userAvgRating"),
        F.lit("0.10").alias("userRatingStddev"), *[F.lit("T").alias(f"userType{i}") for i in range(1, 6)])


def test_click_models_learn_planted_structure(spark):
    s = planted_samples(spark).checkpoint()
    train, test = s.where("timestamp % 5 != 0"), s.where("timestamp % 5 = 0")
    rate = train.agg(F.avg("label")).first()[0]
    constant = CTR.logloss_accuracy(test.withColumn("p", F.lit(rate))).first().logloss
    for fit in (CTR.ctr_fm, CTR.ctr_linear):
        m = CTR.binary_metrics(spark, CTR.predict(fit(train, FL.frequent_types(train)), test).checkpoint(), fit.__name__).first()
        assert m.auc_roc > 0.65 and m.logloss < constant, (m, constant)


def test_als_beats_the_global_mean(spark):
    k = F.col("id")
    a, b = k % 30, F.floor(k / 30)
    r = spark.range(900).select(a.alias("userId"), b.alias("productId"), k.alias("ts"),
                                (1 + ((a % 3) + 1) * ((b % 4) + 1) / 3.0).alias("rating"), F.lit(0).alias("l_orderkey"), F.lit(0).alias("l_linenumber"))
    train, test = AL.train_test(r)
    got = AL.rmse(AL.fit_als(train).transform(test)).first().rmse
    mean = train.agg(F.avg("rating")).first()[0]
    assert got < 0.5 * AL.rmse(test.withColumn("prediction", F.lit(mean))).first().rmse


def test_click_model_metrics_finite(spark):
    s = training_samples(fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL), fx.RATING_ORDER)
    model = CTR.ctr_linear(s, max_iter=5)
    m = CTR.binary_metrics(spark, CTR.predict(model, s), "linear").first()
    assert all(math.isfinite(m[c]) for c in ("logloss", "accuracy", "auc_roc", "auc_pr"))
    assert 0 <= m.accuracy <= 1
