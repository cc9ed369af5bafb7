"""Sampling, splitting and negative sampling.

Spark's own ``sample``/``randomSplit`` are used where the reference is
unseeded; the key-hash variants give splits that are reproducible on any
engine and stable under recomputation after executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recforge.functions.hashing import draw, share, uniform_excluding
from recforge.operators.prefix import prefix_sum

SAMPLE_FRACTION = 0.1        # share of samples kept before the split
TRAIN_FRACTION = 0.8         # train share of the split
TIME_QUANTILE = 0.8          # time split point
QUANTILE_ERROR = 0.05        # relative error of the approximate quantile
NEGATIVE_ID_DOMAIN = 1001    # negatives are ids 0 .. 1000
NEGATIVE_SLOTS = (2, 3, 4, 5)  # history slots that get a negative


def downsample(df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int | None = None) -> DataFrame:
    """X1 (native): Bernoulli sample."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float] = (TRAIN_FRACTION, 1 - TRAIN_FRACTION), seed: int | None = None):
    """X2 (native): Spark's randomSplit."""
    return df.randomSplit(list(weights), seed=seed)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float = SAMPLE_FRACTION, seed: int = 0) -> DataFrame:
    """X1 (reproducible): keep rows whose draw by key is below ``fraction`` (to 2^-60)."""
    return df.where(draw(seed, *(F.col(k) for k in keys)) < share(fraction))


def hash_split(df: DataFrame, keys: Sequence[str], train: float = TRAIN_FRACTION, seed: int = 1) -> DataFrame:
    """X2 (reproducible): add ``split`` = 'train' / 'test' by a draw by key; another seed is another draw."""
    return df.withColumn("split", F.when(draw(seed, *(F.col(k) for k in keys)) < share(train), "train").otherwise("test"))


def time_quantile(df: DataFrame, col: str = "timestamp", q: float = TIME_QUANTILE, err: float = QUANTILE_ERROR) -> Column:
    """Approximate quantile of a column as a scalar-subquery column
    (``percentile_approx`` accuracy = 1 / err)."""
    return df.agg(F.percentile_approx(col, q, int(round(1 / err)))).scalar()


def exact_time_quantile(df: DataFrame, col: str = "timestamp", q: float = TIME_QUANTILE) -> Column:
    """The least value at or below which a share ``q`` of the rows lies, as a scalar subquery.
    Rows are counted by value and the counts summed range by range, so no task holds all values."""
    counts = prefix_sum(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")), [col], "n")
    total = counts.agg(F.sum("n")).scalar()
    return counts.where(F.col("hi") >= total * F.lit(q)).agg(F.min(col)).scalar()


def time_split(df: DataFrame, col: str = "timestamp", q: float = TIME_QUANTILE, exact: bool = False,
               err: float = QUANTILE_ERROR) -> DataFrame:
    """``split`` = 'train' when col <= split point, else 'test'.  The
    split point is the approximate quantile (the reference's rule; a
    bounded sketch merged map-side) or, with ``exact``, the exact lower one."""
    point = exact_time_quantile(df, col, q) if exact else time_quantile(df, col, q, err)
    return df.withColumn("split", F.when(F.col(col) <= point, "train").otherwise("test"))


def negative_items(
    df: DataFrame,
    key_cols: Sequence[str] = ("userId", "productId", "timestamp"),
    slots: Sequence[int] = NEGATIVE_SLOTS,
    n_items: int = NEGATIVE_ID_DOMAIN,
    seed: int = 2020,
    prefix: str = "userRatedproduct",  # with "negtive_" before it, a consumer's column name: fixed
) -> DataFrame:
    """For each history slot, a uniform id in 0..n_items-1 other than
    the slot's own id (a null slot counts as 0)."""
    out = df
    for s in slots:
        own = F.coalesce(F.col(f"{prefix}{s}").cast("long"), F.lit(0))
        out = out.withColumn(f"negtive_{prefix}{s}", uniform_excluding(draw(seed, *(F.col(k) for k in key_cols), F.lit(s)), own, n_items))
    return out
