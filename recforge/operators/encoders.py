"""Feature encoders.

Index and vector encoders are ``pyspark.ml`` transformers; the rest are
column expressions.  Every estimator fit here is a distributed Spark job
whose model is small (a vocabulary, split points, a min and a max).
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    CountVectorizerModel,
    MinMaxScaler,
    OneHotEncoder,
    QuantileDiscretizer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recforge.functions.hashing import draw
from recforge.functions.scalar import TYPE_SEPARATOR

# Fixed values that must equal the reference's for equal results.
PRODUCT_ID_BUCKETS = 1001   # identity buckets of productId
USER_ID_BUCKETS = 30001     # identity buckets of userId
CROSS_BUCKETS = 10000       # hash buckets of productId x userRatedproduct1
QUANTILE_BUCKETS = 100      # buckets of ratingCount
TYPE_VOCABULARY = [
    "PropertyInsurance", "LifeInsurance", "MedicalInsurance", "AccidentInsurance", "ShortTermBonds",
    "LediumTermBonds", "LongTermBonds", "StockFunds", "BondFunds", "MoneyMarketFunds", "MixedFunds",
    "Gold", "Silver", "Platinum", "Palladium", "LDW", "LDZW", "ZDLW",
]


def product_types(products: DataFrame) -> DataFrame:
    """One row per (product, type); products with null types vanish."""
    return products.select("productId", "title", F.explode(F.split("types", re.escape(TYPE_SEPARATOR))).alias("type"))


def one_hot(df: DataFrame, col: str = "productId", out: str = "productIdVector") -> DataFrame:
    """Integer id to a sparse indicator vector, last level kept."""
    tmp = df.withColumn(col + "Number", F.col(col).cast("int"))
    model = OneHotEncoder(inputCols=[col + "Number"], outputCols=[out], dropLast=False).fit(tmp)
    return model.transform(tmp)


def index_types(exploded: DataFrame) -> tuple[DataFrame, list[str]]:
    """Type -> typeIndex (most frequent 0, ties alphabetical); returns
    the indexed frame and the fitted labels."""
    model = StringIndexer(inputCol="type", outputCol="typeIndex", stringOrderType="frequencyDesc").fit(exploded)
    out = model.transform(exploded).withColumn("typeIndexInt", F.col("typeIndex").cast("int"))
    return out, list(model.labels)


def type_index_lists(indexed: DataFrame) -> DataFrame:
    """A5: productId, typeIndexes (sorted list of indices)."""
    return indexed.groupBy("productId").agg(F.array_sort(F.collect_list("typeIndexInt")).alias("typeIndexes"))


def vocabulary_size(indexed: DataFrame) -> DataFrame:
    """One row, max index + 1."""
    return indexed.agg((F.max("typeIndexInt") + 1).alias("indexSize"))


def multi_hot(products: DataFrame) -> DataFrame:
    """productId, vector: the product's type set as a 0/1 sparse vector
    over the frequency-ordered type vocabulary (a repeated type counts once)."""
    exploded = product_types(products)
    _, labels = index_types(exploded)
    cv = CountVectorizerModel.from_vocabulary(labels, inputCol="_types", outputCol="vector", binary=True)
    grouped = products.select("productId", F.split("types", re.escape(TYPE_SEPARATOR)).alias("_types")).where(
        F.col("_types").isNotNull()
    )
    return cv.transform(grouped).drop("_types")


def sparse_indices(vec: Column) -> Column:
    """Indices of the non-zero entries of an ML vector, ascending.  A sparse vector is read as
    it is stored, never widened."""
    raw = F.unwrap_udt(vec)
    stored = F.when(raw["type"] == 0, raw["indices"]).otherwise(F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    pairs = F.filter(F.arrays_zip(stored.alias("i"), raw["values"].alias("v")), lambda p: p["v"] != 0)
    return F.transform(pairs, lambda p: p["i"])


def vector_size(vec: Column) -> Column:
    """Width of an ML vector."""
    raw = F.unwrap_udt(vec)
    return F.when(raw["type"] == 0, raw["size"]).otherwise(F.size(raw["values"])).cast("int")


def offenders(df: DataFrame, col: str, n: int) -> DataFrame:
    """One row with ``rows`` and ``offenders``, those with an id outside [0, n)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if((F.col(col) < 0) | (F.col(col) >= n)).alias("offenders"))


def bucket_and_scale(stats: DataFrame, buckets: int = QUANTILE_BUCKETS) -> DataFrame:
    """E4 + E5 + E6: quantile buckets of ratingCount and min-max scaled
    avgRating, fitted together as one Pipeline."""
    vec = stats.withColumn("avgRatingVec", array_to_vector(F.array(F.col("avgRating").cast("double"))))
    pipe = Pipeline(stages=[
        QuantileDiscretizer(numBuckets=buckets, inputCol="ratingCount", outputCol="ratingCountBucket"),
        MinMaxScaler(inputCol="avgRatingVec", outputCol="scaleAvgRating"),
    ])
    return pipe.fit(vec).transform(vec)


def minmax(df: DataFrame, col: str, out: str) -> DataFrame:
    """E5 as an expression: (x - min) / (max - min), constant column -> 0.5
    (MinMaxScaler's rule).  min and max are scalar subqueries."""
    lo = df.agg(F.min(col)).scalar()
    hi = df.agg(F.max(col)).scalar()
    scaled = F.when(hi == lo, F.lit(0.5)).otherwise((F.col(col) - lo) / (hi - lo))
    return df.withColumn(out, scaled)


def identity_index(col: Column, n: int) -> Column:
    """Id kept when in [0, n), else null."""
    return F.when((col >= 0) & (col < n), col.cast("long"))


def vocab_index(col: Column, vocab: list[str] = TYPE_VOCABULARY) -> Column:
    """Position in the vocabulary, -1 when unknown or null."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in vocab]), col) - 1, F.lit(-1)).cast("int")


def indicator(df: DataFrame, index: str, n: int, out: str) -> DataFrame:
    """One-hot of an index in [0, n) as a sparse vector of width n; an
    unknown (out of range or null) index gives all zeros.

    Unknown indices map to category n, which ``dropLast`` encodes as the
    zero vector; the encoder is fitted on a one-row frame holding n, so the
    width is fixed whatever the data holds.
    """
    from pyspark.sql import SparkSession

    tmp = f"_{out}_idx"
    ok = (F.col(index) >= 0) & (F.col(index) < n)
    mapped = df.withColumn(tmp, F.when(ok, F.col(index)).otherwise(F.lit(n)).cast("int"))
    spark = SparkSession.getActiveSession()
    top = spark.range(1).select(F.lit(n).cast("int").alias(tmp))
    enc = OneHotEncoder(inputCols=[tmp], outputCols=[out], dropLast=True).fit(top)
    return enc.transform(mapped).drop(tmp)


def crossed(a: Column, b: Column, buckets: int = CROSS_BUCKETS, seed: int = 0) -> Column:
    """Hash cross of two integer columns into ``buckets`` buckets.  A
    null side counts as 0."""
    return F.pmod(draw(seed, F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))), F.lit(buckets)).cast("int")


NUMERIC_FEATURES = [
    "releaseYear", "productRatingCount", "productAvgRating", "productRatingStddev",
    "userRatingCount", "userAvgRating", "userRatingStddev",
]


def numeric_sample_features(samples: DataFrame) -> DataFrame:
    """Parse the formatted sample statistics back to doubles (thousands
    separators removed; null -> 0, as the consumer's fill does)."""
    out = samples
    for c in NUMERIC_FEATURES:
        out = out.withColumn(c, F.coalesce(F.regexp_replace(F.col(c).cast("string"), ",", "").try_cast("double"), F.lit(0.0)))
    return out


def cross_encoder():
    """Sparse one-hot of the cross bucket with a fixed width of CROSS_BUCKETS
    (fitted on a one-row frame holding the top bucket, so the width never
    depends on which buckets the data happens to hit)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    top = spark.range(1).select(F.lit(CROSS_BUCKETS - 1).cast("int").alias("_crossIdx"))
    return OneHotEncoder(inputCols=["_crossIdx"], outputCols=["_cross"], dropLast=False).fit(top)
