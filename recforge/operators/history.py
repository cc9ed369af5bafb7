"""Leak-free user-history features over the preceding rows.

All seven outputs share one window spec and are computed in one ``select``,
so the plan has one Window node behind one exchange.  Hot users are cut into
chunks by ``chunk_frames`` so no single task owns a heavy user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recforge.functions.arrays import first_n, rank_by_frequency
from recforge.functions.scalar import TYPE_SEPARATOR, fmt2
from recforge.operators.frames import CHUNK, CTX, DEFAULT_ROWS_PER_CHUNK, chunk_frames

HISTORY_ROWS = 100   # frame: this many preceding rows, current row excluded
HISTORY_SLOTS = 5    # userRatedproduct1..5, userType1..5
MIN_HISTORY = 1      # keep rows whose userRatingCount is above this


def add_user_features(
    df: DataFrame,
    order_cols: Sequence[str] = ("ts", "productId"),
    history: int = HISTORY_ROWS,
    slots: int = HISTORY_SLOTS,
    min_history: int = MIN_HISTORY,
    rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Needs userId, productId, rating, label, releaseYear, types and the
    order columns.  Adds userRatedproduct1..n, userRatingCount,
    userAvgReleaseYear, userReleaseYearStddev, userAvgRating,
    userRatingStddev, userType1..n; drops ``types``; keeps rows with more
    than ``min_history`` preceding ratings.  ``counted`` is a cheap table with
    the same users' rows, on which hot users are found."""
    framed = chunk_frames(df, "userId", list(order_cols), preceding=history, rows_per_chunk=rows_per_chunk,
                          counted=counted)
    # split each product's types once, not once per frame that contains it
    framed = framed.withColumn("_typeArr", F.split("types", "\\" + TYPE_SEPARATOR))
    w = Window.partitionBy("userId", CHUNK).orderBy(*order_cols).rowsBetween(-history, -1)
    positive = F.col("label") == 1
    keep = [c for c in df.columns if c != "types"]
    step1 = framed.select(
        *keep,
        CTX,
        F.reverse(F.collect_list(F.when(positive, F.col("productId"))).over(w)).alias("_hist"),
        F.count(F.lit(1)).over(w).alias("userRatingCount"),
        F.avg("releaseYear").over(w).cast("int").alias("userAvgReleaseYear"),
        fmt2(F.stddev("releaseYear").over(w)).alias("userReleaseYearStddev"),
        fmt2(F.avg("rating").over(w)).alias("userAvgRating"),
        fmt2(F.stddev("rating").over(w)).alias("userRatingStddev"),
        F.collect_list(F.when(positive, F.col("_typeArr"))).over(w).alias("_types"),
    ).where(~F.col(CTX) & (F.col("userRatingCount") > min_history))
    step2 = step1.withColumn("_words", F.flatten("_types"))
    step3 = step2.withColumn("_ranked", rank_by_frequency(F.col("_words")))
    return step3.select(
        *keep,
        *first_n(F.col("_hist"), slots, "userRatedproduct"),
        "userRatingCount",
        "userAvgReleaseYear",
        "userReleaseYearStddev",
        "userAvgRating",
        "userRatingStddev",
        *first_n(F.col("_ranked"), slots, "userType"),
    )
