"""Facts about models whose rows no SQL engine can recompute.

Each query trains what its namesake trains and returns (fact, value) rows that
SQL can state from the tables alone: how many keys there must be, and 0 for
every count of rows that break a rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recforge.functions.vectors import dot, sq_euclidean
from recforge.operators import als as AL
from recforge.operators import cooccurrence as CO
from recforge.operators import ctr as CTR
from recforge.operators import embeddings as E
from recforge.operators import encoders as ENC
from recforge.operators import fields as FL
from recforge.operators import item2vec as I2V
from recforge.operators import ivf as IVF
from recforge.operators.laid import stored
from recforge.operators import products as P
from recforge.operators import quantiles as QU
from recforge.operators import sequences as Q
from recforge.operators import splits as SP
from recforge.operators import walks as W
from recforge.plans.samples import training_samples
from recforge.sources import fixtures as fx

ORDER = list(fx.RATING_ORDER)
NEIGHBOURS = 5
DEGENERATE = 1.05  # times the log loss of the label's share; labels are unrelated to the features here


def listed(*parts: DataFrame) -> DataFrame:
    """One-row frames of counts as (fact, value) rows."""
    out = None
    for part in parts:
        pairs = ", ".join(f"'{c}', cast({c} as bigint)" for c in part.columns)
        rows = part.select(F.expr(f"stack({len(part.columns)}, {pairs}) as (fact, value)"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _als(spark: SparkSession, sf: str):
    train, test = AL.model_input(fx.ratings(spark, sf))
    return AL.fit_als(train), train, test


def _rank_rules(recs: DataFrame, key: str) -> list[DataFrame]:
    """Keys, rows, and rows that break an order: ranks 1..n without gaps, ratings that never rise."""
    before = Window.partitionBy(key).orderBy("rank")
    checked = recs.withColumn("_n", F.row_number().over(before)).withColumn("_last", F.lag("rating").over(before))
    return [checked.agg(F.countDistinct(key).alias("keys"), F.count(F.lit(1)).alias("rows_out"),
                        F.count_if(F.col("rank") != F.col("_n")).alias("rank_gaps"),
                        F.count_if(F.col("rating") > F.col("_last")).alias("rating_rises"))]


def als_facts(spark: SparkSession, sf: str, key: str) -> DataFrame:
    """Every key has its k best; for the subset's keys they are those of brute force over the factors."""
    model, train, _ = _als(spark, sf)
    other = "productIdInt" if key == "userIdInt" else "userIdInt"
    recs = (AL.user_recs if key == "userIdInt" else AL.item_recs)(model)
    chosen = AL.distinct_ids(train, key)
    subset = (AL.user_subset_recs if key == "userIdInt" else AL.item_subset_recs)(model, chosen)
    users, items = (f.select(F.col("id").alias(c), F.col("features").alias(f"_{c}"))
                    for f, c in ((model.userFactors, "userIdInt"), (model.itemFactors, "productIdInt")))
    mine, theirs = (users, items) if key == "userIdInt" else (items, users)
    # The subset's three keys, as one value, against all rows of the other side.
    few = mine.join(chosen, key).agg(F.collect_list(F.struct(key, f"_{key}"))).scalar()
    scored = theirs.select("*", few.alias("_few")).select("*", F.inline("_few")).select(
        key, other, dot(F.col("_userIdInt"), F.col("_productIdInt")).alias("score"))
    best = E.top_k_by_score(scored, key, other, "score", AL.TOP_K)
    both = subset.join(best.withColumnRenamed(other, "_other"), [key, "rank"], "full")
    wrong = both.agg(F.count_if(F.coalesce(F.abs(F.col("rating") - F.col("score")) > 1e-4, F.lit(True))).alias("subset_not_best"),
                     F.countDistinct(key).alias("subset_keys"))
    unknown = recs.join(train.select(other).distinct(), other, "left_anti").agg(F.count(F.lit(1)).alias("unknown_ids"))
    return listed(*_rank_rules(recs, key), wrong, unknown)


def als_catalogue_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The search by norms finds, for every user and every item, what scoring all pairs of factors finds."""
    model, _, _ = _als(spark, sf)
    parts = []
    for key, name, all_pairs in (("userIdInt", "user", model.recommendForAllUsers(AL.TOP_K)),
                                 ("productIdInt", "item", model.recommendForAllItems(AL.TOP_K))):
        other = "productIdInt" if key == "userIdInt" else "userIdInt"
        plain = AL.explode_recs(all_pairs, key, other).select(key, "rank", F.col("rating").alias("_rating"))
        both = AL.catalogue_recs(model, key).join(plain, [key, "rank"], "full")
        parts.append(both.agg(F.countDistinct(key).alias(f"{name}_keys"), F.count("rating").alias(f"{name}_rows"), F.count_if(
            F.coalesce(F.abs(F.col("rating") - F.col("_rating")) > 1e-4, F.lit(True))).alias(f"{name}_not_the_best")))
    return listed(*parts)


def als_rmse_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Scored test rows, and those whose prediction isn't the dot product of the factors."""
    model, _, test = _als(spark, sf)
    scored = model.transform(test)
    users, items = (f.select(F.col("id").alias(c), F.col("features").alias(f"_{c}"))
                    for f, c in ((model.userFactors, "userIdInt"), (model.itemFactors, "productIdInt")))
    again = scored.join(users, "userIdInt").join(items, "productIdInt")
    off = F.abs(dot(F.col("_userIdInt"), F.col("_productIdInt")) - F.col("prediction")) > 1e-4
    return listed(again.agg(F.count(F.lit(1)).alias("scored"), F.count_if(off).alias("not_the_dot_product")))


def als_cv_facts(spark: SparkSession, sf: str) -> DataFrame:
    rows = AL.cross_validate(spark, AL.model_input(fx.ratings(spark, sf))[0])
    return listed(rows.agg(F.count(F.lit(1)).alias("grid_points"), F.sum("folds").alias("folds"),
                           F.count_if(~F.col("avgRmse").between(0.0, 10.0)).alias("rmse_out_of_range")))


def _vector_rules(emb: DataFrame) -> DataFrame:
    norm = F.sqrt(dot(F.col("emb"), F.col("emb")))
    return emb.agg(F.count(F.lit(1)).alias("vectors"), F.count_if(F.size("emb") != I2V.EMB_SIZE).alias("wrong_sizes"),
                   F.count_if(~(norm > 0) | norm.isNull() | F.isnan(norm)).alias("not_finite"))


def _item2vec(spark: SparkSession, sf: str):
    return I2V.item2vec(Q.item_sequences(fx.ratings(spark, sf), ORDER))


def item2vec_facts(spark: SparkSession, sf: str) -> DataFrame:
    return listed(_vector_rules(I2V.embeddings_from_model(_item2vec(spark, sf))))


def graph_embedding_facts(spark: SparkSession, sf: str) -> DataFrame:
    walks = W.random_walks(spark, Q.pair_counts(fx.ratings(spark, sf), ORDER))
    return listed(_vector_rules(I2V.embeddings_from_model(I2V.graph_embedding(walks))))


def cooccurrence_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors from co-occurrence: one for each item with an association."""
    return listed(_vector_rules(CO.item_vectors(CO.window_counts(fx.ratings(spark, sf), ORDER))))


def walk_vector_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors from co-occurrence on random walks: one for each item walked over that has a neighbour there."""
    walks = W.random_walks(spark, Q.pair_counts(fx.ratings(spark, sf), ORDER))
    return listed(_vector_rules(CO.item_vectors(CO.sentence_counts(walks))))


def ivf_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector is indexed once; the neighbours of all at once have their true scores, and recall is 0.9 or more."""
    vectors = fx.vectors(spark, sf)
    index = IVF.build(vectors)
    found = IVF.neighbours(index, vectors, E.SIMILAR_K).checkpoint()
    exact = IVF.exact_neighbours(vectors, vectors, E.SIMILAR_K).checkpoint()
    indexed = index.rows.select(F.explode("ids").alias("id")).agg(F.count(F.lit(1)).alias("indexed"), F.countDistinct("id").alias("distinct_ids"))
    rows = found.agg(F.countDistinct("query").alias("queries"), F.count(F.lit(1)).alias("rows_out"))
    wrong = found.join(exact.withColumnRenamed("score", "_score"), ["query", "id"]).agg(
        F.count_if(F.abs(F.col("score") - F.col("_score")) > 1e-6).alias("wrong_scores"))
    return listed(indexed, rows, wrong, IVF.recall(found, exact).select((F.col("recall") < 0.9).cast("int").alias("recall_below_90_percent")))


def embedding_chain_facts(spark: SparkSession, sf: str) -> DataFrame:
    """From ratings to item vectors, to each query item's nearest neighbours and to user vectors."""
    vectors = I2V.embeddings_from_model(_item2vec(spark, sf)).select(F.col("productId").cast("long").alias("productId"), "emb")
    users = E.user_embeddings(fx.ratings(spark, sf), vectors)
    table = vectors.select(F.col("productId").alias("vec_id"), F.col("emb").alias("embedding"))
    query = table.agg(F.min_by("embedding", "vec_id")).scalar()
    near = E.nearest_k(table, query, NEIGHBOURS)
    first = near.agg(F.count(F.lit(1)).alias("neighbours"), F.count_if(F.col("distance") < 0).alias("negative_distances"),
                     F.count_if(F.col("distance") < 1e-9).alias("at_the_query"))
    return listed(users.agg(F.count(F.lit(1)).alias("user_vectors"), F.count_if(F.size("emb") != I2V.EMB_SIZE).alias("wrong_sizes")), first)


def similar_items_facts(spark: SparkSession, sf: str, found: DataFrame) -> DataFrame:
    w = Window.orderBy(F.desc("similarity"), "word")  # at most k rows
    rows = found.withColumn("_n", F.row_number().over(w))
    return listed(rows.agg(F.count(F.lit(1)).alias("rows_out"), F.countDistinct("word").alias("words"),
                           F.count_if(~F.col("similarity").between(-1.001, 1.001)).alias("no_cosine")))


def lsh_facts(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.item_vectors(spark, sf)
    model, vec = I2V.lsh_model(vectors)
    key = [float(x) for x in vectors.where("productId = 0").first()["emb"]]
    near = I2V.approx_neighbours(model, vec, key).select("productId", "distance", "emb")
    own = F.sqrt(sq_euclidean(F.col("emb"), F.array(*(F.lit(x) for x in key))))
    hashed = model.transform(vec).agg(F.count(F.lit(1)).alias("hashed"), F.count_if(F.size("bucketId") != I2V.LSH_TABLES).alias("wrong_tables"))
    return listed(hashed, near.agg(F.count_if(F.col("productId") == 0).alias("finds_itself"), (F.count(F.lit(1)) > I2V.LSH_K).cast("int").alias("too_many"),
                                   F.count_if(F.abs(own - F.col("distance")) > 1e-4).alias("wrong_distances")))


def bucket_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Buckets don't overlap, and scaling keeps order and bounds."""
    out = ENC.bucket_and_scale(P.product_stats(fx.ratings(spark, sf)))
    from pyspark.ml.functions import vector_to_array
    scaled = F.round(vector_to_array("scaleAvgRating")[0], 9)
    ends = out.groupBy("ratingCountBucket").agg(F.min("ratingCount").alias("lo"), F.max("ratingCount").alias("hi"))
    before = F.lag("hi").over(Window.orderBy("ratingCountBucket"))  # a row for each bucket
    overlap = ends.withColumn("_before", before).agg(F.count_if(F.col("lo") <= F.col("_before")).alias("overlaps"))
    return listed(out.agg(F.count(F.lit(1)).alias("products"), F.count_if(~scaled.between(0.0, 1.0)).alias("out_of_bounds"),
                          F.count_if((scaled == 0) | (scaled == 1)).alias("at_bounds")), overlap)


def sketch_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Merged daily sketches: the rank of the split in time, and those of 100 buckets' bounds, are within 2 %."""
    ratings = fx.ratings(spark, sf)
    daily = QU.sketches(ratings, "ts", QU.day_of(F.col("ts"))).checkpoint()
    point = QU.split_point(daily)
    split = ratings.select("ts", point.alias("_p")).agg(F.avg((F.col("ts") <= F.col("_p")).cast("double")).alias("share"))
    counts = P.product_stats(ratings).select("productId", "ratingCount")
    kept = QU.sketches(counts, "ratingCount", F.pmod("productId", F.lit(10))).checkpoint()
    bounds = QU.quantiles(kept, [i / 100 for i in range(1, 100)]).agg(F.collect_list(F.struct("rank", "value"))).scalar()  # 99
    ranks = counts.select("ratingCount", bounds.alias("_b")).select("ratingCount", F.inline("_b")).groupBy("rank", "value").agg(
        F.avg((F.col("ratingCount") < F.col("value")).cast("double")).alias("lo"), F.avg((F.col("ratingCount") <= F.col("value")).cast("double")).alias("hi"))
    off = (F.col("lo") > F.col("rank") + 0.02) | (F.col("hi") < F.col("rank") - 0.02)
    return listed(daily.agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("ratings")),
                  split.select((F.abs(F.col("share") - 0.8) > 0.02).cast("int").alias("split_is_off")),
                  ranks.agg(F.count(F.lit(1)).alias("bounds"), F.count_if(off).alias("bounds_off")))


def time_split_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate split point's rank is within the error, and the parts don't overlap."""
    split = SP.time_split(training_samples(fx.ratings(spark, sf), fx.products(spark, sf), ORDER).select("timestamp"))
    train, test = F.col("split") == "train", F.col("split") == "test"
    counts = split.agg(F.count(F.lit(1)).alias("n"), F.count_if(train).alias("t"), F.max(F.when(train, F.col("timestamp"))).alias("hi"),
                       F.min(F.when(test, F.col("timestamp"))).alias("lo"))
    return listed(counts.select(F.col("n").alias("samples"), (F.abs(F.col("t") / F.col("n") - 0.8) > 0.05).cast("int").alias("share_is_off"),
                                F.coalesce(F.col("lo") <= F.col("hi"), F.lit(False)).cast("int").alias("parts_overlap")))


def ctr_facts(spark: SparkSession, sf: str, split) -> DataFrame:
    """For each click model: scored rows, and whether its log loss is far above that of the label's share."""
    train, test = split(spark, sf)
    rate = train.agg(F.avg("label")).first()[0]
    constant = CTR.logloss_accuracy(test.withColumn("p", F.lit(rate))).first().logloss
    parts = []
    vocab = FL.frequent_types(train)
    fitted = {}
    for name, fit in CTR.MODELS.items():
        given = {"boosted": fitted["trees"]} if name == "leaves" else {}  # the same trees, not fitted twice
        fitted[name] = fit(train, vocab, **given)
        scored = stored(CTR.predict(fitted[name], test).select("label", "p"), "scored")
        loss = CTR.logloss_accuracy(scored).select(F.col("n").alias(f"{name}_scored"), (F.col("logloss") > DEGENERATE * constant).cast("int").alias(f"{name}_is_degenerate"))
        parts += [loss, scored.agg(F.count_if(~F.col("p").between(0.0, 1.0)).alias(f"{name}_no_probability"),
                                   (F.countDistinct("p") < 2).cast("int").alias(f"{name}_is_constant"))]
    return listed(*parts)
