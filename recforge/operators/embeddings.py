"""Embedding tables: user vectors, nearest neighbours, dot-product scores,
factorization-machine terms (A10, J3, K8, K9, M9, E12, E13).

Vectors are ``array<float>`` columns.  Query vectors enter plans as scalar
subqueries (one row, one column), never through a cross join or the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recforge.functions.vectors import cosine, dot, fm_pairwise, sq_euclidean

KNN_K = 5         # nearest neighbours of a query vector
FEW = 1 << 16      # items that may be broadcast, as ids alone
SIMILAR_K = 20    # most similar items to an item


def ratings_with_vectors(ratings: DataFrame, item_emb: DataFrame) -> DataFrame:
    """Inner join on productId; ratings of items without a vector drop.

    Plain equi-join: Spark broadcasts the embedding table when its measured
    size allows and otherwise shuffles, with AQE splitting skewed items.
    """
    return ratings.join(item_emb, "productId")


def user_embeddings(ratings: DataFrame, item_emb: DataFrame) -> DataFrame:
    """A10: userId, emb = element-wise **sum** of the vectors of every item
    the user rated (all ratings, repeats counted).

    Repeats are first counted per (user, item) so the join carries one row
    per distinct pair of an item with a vector; a dimension's sum is a plain
    aggregate, which combines partial sums map-side (a heavy user costs no more
    shuffle than a light one) and keeps them as numbers.  A job finds the
    vectors' length; one of another length fails.
    """
    known, dims = _equally_long(item_emb.where("emb is not null"))
    ids = item_emb.where("emb is not null").select("productId")
    if ids.limit(FEW + 1).count() <= FEW:  # ratings of other items leave before they are exchanged
        ratings = ratings.join(F.broadcast(ids), "productId", "left_semi")
    pairs = ratings.groupBy("userId", "productId").agg(F.count(F.lit(1)).alias("_n"))
    joined = ratings_with_vectors(pairs, known)
    sums = [F.sum(F.get("emb", F.lit(i)).cast("double") * F.col("_n")).alias(f"_{i}") for i in range(dims)]
    total = joined.groupBy("userId").agg(F.count(F.lit(1)).alias("_items"), *sums)
    return total.select("userId", F.array(*(f"_{i}" for i in range(dims))).cast("array<double>").alias("emb"))


def _equally_long(item_emb: DataFrame) -> tuple[DataFrame, int]:
    """The item vectors, of which one of another length fails when it is read, and their length, found by a job."""
    first = item_emb.where("emb is not null").select(F.size("emb").alias("n")).first()
    dims = first["n"] if first else 0
    other = F.raise_error(F.lit("vectors of unequal length")).cast(item_emb.schema["emb"].dataType)
    return item_emb.withColumn("emb", F.when(F.col("emb").isNull() | (F.size("emb") == dims), F.col("emb")).otherwise(other)), dims


def rated_pairs_with_vectors(ratings: DataFrame, item_emb: DataFrame) -> DataFrame:
    """(userId, productId, a, b) for each distinct rated pair of an item of ``item_emb``: the user's vector, as
    ``user_embeddings`` has it, and the item's.  Pairs of a user without a vector drop.

    An item's vector is sent to the user once: the sums are taken over the rows that want them, so neither partial
    sums nor user vectors are exchanged.  A user's rows, at most one for each vector, are in one window, which spills.
    """
    known, dims = _equally_long(item_emb.select("productId", "emb"))
    pairs = ratings.where("userId is not null").groupBy("userId", "productId").agg(F.count(F.lit(1)).alias("_n"))
    # Dealt and sorted as they are: the window would have the products, twice as wide, computed before.
    rows = pairs.join(known, "productId").repartition("userId").sortWithinPartitions("userId")
    own = Window.partitionBy("userId")
    sums = [F.sum(F.get("emb", F.lit(i)).cast("double") * F.col("_n")).over(own).alias(f"_{i}") for i in range(dims)]
    rows = rows.select("userId", "productId", "emb", F.count("emb").over(own).alias("_items"), *sums)
    a = F.array(*(f"_{i}" for i in range(dims))).cast("array<double>")
    return rows.where(F.col("_items") > 0).select("userId", "productId", a.alias("a"), F.col("emb").alias("b"))


def query_vector(vectors: DataFrame, vec_id: int) -> Column:
    """The embedding of ``vec_id`` as a scalar subquery column; a query with an unknown id fails."""
    found = vectors.where(F.col("vec_id") == vec_id).select("embedding").scalar()
    return F.coalesce(found, F.raise_error(F.lit(f"no vector with id {vec_id}")).cast("array<float>"))


def nearest_k(vectors: DataFrame, query: Column, k: int = KNN_K) -> DataFrame:
    """K8: exact k nearest by Euclidean distance (ties by id).  ``orderBy +
    limit`` plans as a per-partition top-k merged once (TakeOrderedAndProject)."""
    d = F.sqrt(sq_euclidean(F.col("embedding"), F.col("_q")))
    with_q = vectors.select("vec_id", "embedding", query.alias("_q"))
    return with_q.select("vec_id", d.alias("distance")).orderBy("distance", "vec_id").limit(k)


def most_similar(vectors: DataFrame, vec_id: int, k: int = SIMILAR_K) -> DataFrame:
    """K9: the k items most cosine-similar to ``vec_id`` (itself excluded)."""
    q = query_vector(vectors, vec_id)
    sim = cosine(F.col("embedding"), F.col("_q"))
    return (
        vectors.where(F.col("vec_id") != vec_id)
        .select("vec_id", "embedding", q.alias("_q"))
        .select("vec_id", sim.alias("similarity"))
        .where("similarity is not null")  # a zero vector is similar to none
        .orderBy(F.col("similarity").desc(), "vec_id")
        .limit(k)
    )


def top_k_by_score(scored: DataFrame, key: str, item: str, score: str, k: int) -> DataFrame:
    """Top k items per key by score (ties by item).  ``row_number <= k`` is
    limited per map partition before the shuffle (WindowGroupLimit), so a
    key with many rows sends at most k rows per partition."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(item))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def next_item_candidates(ratings: DataFrame, pairs: DataFrame, item_emb: DataFrame | None = None) -> DataFrame:
    """(userId, productId) worth scoring: every item that ever follows one the user rated, without those already rated.

    ``item_emb``, if given, leaves out the followers without a vector, which have no score, before they are joined to users.

    The best of the whole catalogue are found by ``catalogue.catalogue_top_k``."""
    rated = ratings.select("userId", "productId").distinct()
    follow = pairs.select(F.col("src").alias("productId"), "dst").distinct()
    if item_emb is not None:
        known = item_emb.where("emb is not null").select(F.col("productId").alias("dst"))
        follow = follow.join(known, "dst", "left_semi")
    found = rated.join(follow, "productId").select("userId", F.col("dst").alias("productId")).distinct()
    return found.join(rated, ["userId", "productId"], "left_anti")


def two_tower_scores(pairs: DataFrame, user_emb: DataFrame, item_emb: DataFrame, k: int = 10) -> DataFrame:
    """M9: score (user, item) pairs by the dot product of the user-tower and
    item-tower vectors; keep each user's top k.  Only the given pairs are
    scored (no user x item cross product).  Pairs whose item has no vector
    leave before anything as wide as a vector is joined to a pair."""
    u = user_emb.select("userId", F.col("emb").alias("_u"))
    i = item_emb.select("productId", F.col("emb").alias("_i"))
    known = pairs.select("userId", "productId").join(item_emb.where("emb is not null").select("productId"), "productId", "left_semi")
    scored = known.distinct().join(i, "productId").join(u, "userId")
    scored = scored.select("userId", "productId", dot(F.col("_u"), F.col("_i")).alias("score"))
    return top_k_by_score(scored, "userId", "productId", "score", k)


def fm_interaction(fields: list[Column]) -> Column:
    """Per-dimension FM term over field vectors."""
    return fm_pairwise(fields)


def pair_dots(pairs: dict[str, tuple[Column, Column]]) -> list[Column]:
    """Named dot products of field-vector pairs."""
    return [dot(a, b).alias(name) for name, (a, b) in pairs.items()]
