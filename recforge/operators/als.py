"""Collaborative filtering with ALS."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recforge.operators.catalogue import BLOCK, SLAB, catalogue_top_k
from recforge.operators.splits import hash_split

# Fixed values of the reference job.
REG_PARAM = 0.01
MAX_ITER = 5
TOP_K = 10
CV_FOLDS = 10
SUBSET_SIZE = 3

LEAST_BLOCKS = 10  # Spark's default
BLOCK_ROWS = 1_000_000  # ratings of a block, about


def typed_ratings(df: DataFrame) -> DataFrame:
    """Integer user, integer product, float rating (bad values -> null)."""
    return df.withColumns({
        "userIdInt": F.col("userId").try_cast("int"),
        "productIdInt": F.col("productId").try_cast("int"),
        "ratingFloat": F.col("rating").try_cast("float"),
    })


def make_als(seed: int = 42, **kw) -> ALS:
    return ALS(regParam=REG_PARAM, maxIter=MAX_ITER, userCol="userIdInt", itemCol="productIdInt",
               ratingCol="ratingFloat", coldStartStrategy="drop", seed=seed, **kw)


SPLIT_KEYS = ("userId", "productId", "ts", "l_orderkey", "l_linenumber")
SPLIT_SEED = 7


def train_test(ratings: DataFrame, keys=SPLIT_KEYS, seed: int = SPLIT_SEED):
    """Reproducible 80/20 split by key hash (stable if tasks are recomputed)."""
    split = hash_split(typed_ratings(ratings), list(keys), seed=seed)
    return split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")


def model_input(ratings: DataFrame):
    """The parts of ``train_test`` with nothing but what a model reads, computed once: a fit reads its rows again for each
    fold and each part, and would join and deal the ratings anew each time."""
    split = hash_split(typed_ratings(ratings), list(SPLIT_KEYS), seed=SPLIT_SEED) \
        .select("userIdInt", "productIdInt", "ratingFloat", "split").checkpoint()
    return split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")


def blocks_for(rows: int) -> dict[str, int]:
    """Blocks of users and of items, so that a task holds about ``BLOCK_ROWS`` ratings of one; Spark's own ten for fewer."""
    blocks = max(LEAST_BLOCKS, -(-rows // BLOCK_ROWS))
    return {"numUserBlocks": blocks, "numItemBlocks": blocks}


def fit_als(train: DataFrame, seed: int = 42) -> ALSModel:
    """M4: fit ALS (explicit ratings, default rank)."""
    return make_als(seed, **blocks_for(train.count())).fit(train)


def rmse(predictions: DataFrame, label: str = "ratingFloat", prediction: str = "prediction") -> DataFrame:
    """M10 as a one-row DataFrame: sqrt(mean((prediction - label)^2))."""
    err = F.col(prediction).cast("double") - F.col(label).cast("double")
    return predictions.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def rmse_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(predictionCol="prediction", labelCol="ratingFloat", metricName="rmse")


def explode_recs(recs: DataFrame, key: str, other: str) -> DataFrame:
    """K4-K7 output, one row per (key, recommended, rank, rating)."""
    return recs.select(key, F.posexplode("recommendations").alias("pos", "rec")).select(
        F.col(key), F.col("rec")[other].alias(other), (F.col("pos") + 1).alias("rank"), F.col("rec")["rating"].alias("rating")
    )


def user_recs(model: ALSModel, k: int = TOP_K) -> DataFrame:
    """K4; see ``catalogue_recs``."""
    return catalogue_recs(model, "userIdInt", k)


def item_recs(model: ALSModel, k: int = TOP_K) -> DataFrame:
    """K5; see ``catalogue_recs``."""
    return catalogue_recs(model, "productIdInt", k)


def catalogue_recs(model: ALSModel, key: str, k: int = TOP_K, block: int = BLOCK) -> DataFrame:
    """K4 (``key`` userIdInt) and K5 (productIdInt) by bounds on norms: the k best of the other side for every
    key, without scoring every pair.  Columns as those of ``explode_recs``, ratings the floats that the model predicts; of
    equal ratings the larger id is first, as in ``recommendForAll``."""
    sides = {"userIdInt": model.userFactors, "productIdInt": model.itemFactors}
    other = next(c for c in sides if c != key)
    mine, theirs = (sides[c].select(F.col("id").alias(c), F.col("features").alias("emb")) for c in (key, other))
    theirs = theirs.withColumn(other, -F.col(other).cast("bigint"))
    best = catalogue_top_k(mine, theirs, k, query_id=key, item_id=other, block=block, single=True, first=SLAB)
    return best.select(F.col(key).cast("int").alias(key), (-F.col(other)).cast("int").alias(other), "rank", F.col("score").cast("float").alias("rating"))


def distinct_ids(df: DataFrame, col: str, n: int = SUBSET_SIZE) -> DataFrame:
    """The n smallest distinct ids (ordering makes the pick deterministic)."""
    return df.select(col).distinct().orderBy(col).limit(n)


def user_subset_recs(model: ALSModel, users: DataFrame, k: int = TOP_K) -> DataFrame:
    return explode_recs(model.recommendForUserSubset(users, k), "userIdInt", "productIdInt")


def item_subset_recs(model: ALSModel, items: DataFrame, k: int = TOP_K) -> DataFrame:
    return explode_recs(model.recommendForItemSubset(items, k), "productIdInt", "userIdInt")


def cross_validate(spark: SparkSession, train: DataFrame, folds: int = CV_FOLDS, seed: int = 42) -> DataFrame:
    """K-fold cross-validation of the one-point grid on the training
    part (the reference fits on test); one row per grid point."""
    als = make_als(seed, **blocks_for(train.count()))
    grid = ParamGridBuilder().addGrid(als.regParam, [REG_PARAM]).build()
    cv = CrossValidator(estimator=als, estimatorParamMaps=grid, evaluator=rmse_evaluator(), numFolds=folds, seed=seed)
    model = cv.fit(train)
    return spark.createDataFrame([(float(REG_PARAM), float(m), folds) for m in model.avgMetrics],
                                 "regParam double, avgRmse double, folds int")
