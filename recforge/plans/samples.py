"""Training-sample job: label, product features, user history, sample, split, save."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.operators.frames import DEFAULT_ROWS_PER_CHUNK
from recforge.operators.history import HISTORY_ROWS, add_user_features
from recforge.operators.labels import add_label
from recforge.operators.products import join_products, product_rating_features
from recforge.operators.splits import SAMPLE_FRACTION, TRAIN_FRACTION, hash_sample, hash_split, time_split
from recforge.sources.files import write_samples

# Columns that name a sample row.
SAMPLE_KEY = ("userId", "productId", "timestamp")

# Column order of a sample row (producer -> consumer contract).
SAMPLE_COLUMNS = (
    ["userId", "productId", "rating", "timestamp", "label", "releaseYear"]
    + [f"productType{i}" for i in range(1, 4)]
    + ["productRatingCount", "productAvgRating", "productRatingStddev"]
    + [f"userRatedproduct{i}" for i in range(1, 6)]
    + ["userRatingCount", "userAvgReleaseYear", "userReleaseYearStddev", "userAvgRating", "userRatingStddev"]
    + [f"userType{i}" for i in range(1, 6)]
)


def training_samples(
    ratings: DataFrame,
    products: DataFrame,
    order_cols: Sequence[str] = ("ts", "productId"),
    history: int = HISTORY_ROWS,
    rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK,
) -> DataFrame:
    """One wide row per rating event after a user's second: the event, its
    product's features and the user's history just before it."""
    labelled = add_label(ratings)
    # Product statistics cover every rating (not just the kept rows).  They are joined beside the product's
    # attributes, by the same key and before the window: rows are dealt by product while they are narrow, and
    # the far wider rows that leave the window aren't dealt again.
    with_product = join_products(labelled, products).join(product_rating_features(labelled), on=["productId"], how="left")
    with_user = add_user_features(with_product, order_cols, history=history,
                                  rows_per_chunk=rows_per_chunk, counted=ratings.select("userId"))
    return with_user.withColumnRenamed("ts", "timestamp").select(*SAMPLE_COLUMNS)


def minimum_slice(ratings: DataFrame, products: DataFrame, order_cols: Sequence[str] = ("ts", "productId"),
                  rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """The flagship question: for each rating event after a user's second,
    what did that user look like just before it?"""
    cols = ["userId", "productId", "timestamp", "label", "releaseYear", "userRatingCount",
            "userAvgReleaseYear", "userAvgRating", "userRatingStddev"]
    return training_samples(ratings, products, order_cols, rows_per_chunk=rows_per_chunk).select(*cols)


def save_train_test(samples: DataFrame, path: str, fraction: float = SAMPLE_FRACTION, train: float = TRAIN_FRACTION,
                    by_time: bool = False, fmt: str = "csv", exact: bool = False) -> dict[str, str]:
    """The job's end: sample, split and write ``path``/train and ``path``/test; returns both paths.

    The split is by a draw by key, or, ``by_time``, at the time at or below which a share ``train`` of the sample lies
    (``exact``, or else to the sketch's error).
    """
    kept = hash_sample(samples, list(SAMPLE_KEY), fraction)
    split = time_split(kept, q=train, exact=exact) if by_time else hash_split(kept, list(SAMPLE_KEY), train)
    split = split.checkpoint()  # both parts are written from one computation
    paths = {part: f"{path}/{part}" for part in ("train", "test")}
    for part, to in paths.items():
        write_samples(split.where(F.col("split") == part).drop("split"), to, fmt)
    return paths
