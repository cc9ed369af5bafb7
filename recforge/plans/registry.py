"""Registry of queries (Spark) and their SQL oracle, keyed alike."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recforge.functions import scalar as SF
from recforge.functions import vectors as V
from recforge.operators import catalogue as CAT
from recforge.operators import cooccurrence as CO
from recforge.operators import embeddings as E
from recforge.operators import encoders as ENC
from recforge.operators import fields as FL
from recforge.operators import labels as L
from recforge.operators import products as P
from recforge.operators import sequences as Q
from recforge.operators import splits as SP
from recforge.operators import walks as W
from recforge.operators import als as AL
from recforge.operators import ctr as CTR
from recforge.operators import item2vec as I2V
from recforge.operators import ivf as IVF
from recforge.operators.laid import stored
from pyspark.ml.functions import vector_to_array

from recforge.functions.hashing import draw
from recforge.plans import facts, oracle
from recforge.plans.samples import minimum_slice, save_train_test, training_samples
from recforge.session import ensure_checkpoint_dir
from recforge.sources import files as IO
from recforge.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    return training_samples(fx.ratings(spark, sf), fx.products(spark, sf), fx.RATING_ORDER)


def _minimum(spark: SparkSession, sf: str) -> DataFrame:
    return minimum_slice(fx.ratings(spark, sf), fx.products(spark, sf), fx.RATING_ORDER)


def _r(spark, sf):
    return fx.ratings(spark, sf)


def _round(c, places=6):
    return F.round(F.col(c), places).alias(c)


def _user_emb(spark, sf):
    return E.user_embeddings(_r(spark, sf), fx.item_vectors(spark, sf))


def _distinct_pairs_with_fields(spark, sf):
    return E.rated_pairs_with_vectors(_r(spark, sf), fx.item_vectors(spark, sf))


def _fields(spark, sf):
    """Field vectors of each rated pair: the user's (a), the item's (b) and that of item 0 (z)."""
    base = E.query_vector(fx.vectors(spark, sf), 0)
    return _distinct_pairs_with_fields(spark, sf).withColumn("z", base)


def _fm_dimensions(spark, sf):
    terms = E.fm_interaction([F.col("a"), F.col("b"), F.col("z")])
    thousandths = F.transform(terms, lambda x: F.round(x * 1000).cast("long").cast("string"))
    return _fields(spark, sf).select("userId", "productId", F.array_join(thousandths, ",").alias("terms"))


def _four_dots(spark, sf):
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    dots = E.pair_dots({"item_user": (b, a), "item_base": (b, z), "user_base": (a, z), "item_item": (b, b)})
    rows = _fields(spark, sf).select("userId", "productId", *dots)
    return rows.select("userId", "productId", *[F.round(c, 4).alias(c) for c in ("item_user", "item_base", "user_base", "item_item")])


def _timeline(spark, sf):
    r = _r(spark, sf)
    first = r.agg(F.min("userId")).scalar()
    return r.where(F.col("userId") == first).orderBy(*fx.RATING_ORDER)


# Types that the fixture's products have, for a vocabulary with hits.
FIXTURE_WORDS = ["ECONOMY", "PROMO", "STANDARD", "blue", "gear", "red"]
ORDER = list(fx.RATING_ORDER)
KEY = ["userId", "productId", "timestamp"]


def _als(spark, sf):
    train, test = AL.model_input(_r(spark, sf))
    return AL.fit_als(train), train, test


def _rounded_recs(df):
    return df.withColumn("rating", F.round(F.col("rating").cast("double"), 4))


def _subset(spark, sf, col):
    model, train, _ = _als(spark, sf)
    ids = AL.distinct_ids(train, col)
    return AL.user_subset_recs(model, ids) if col == "userIdInt" else AL.item_subset_recs(model, ids)


def _baseline_rmse(spark, sf):
    train, test = AL.train_test(_r(spark, sf))
    means = train.groupBy("productId").agg(F.avg("rating").alias("prediction"))
    out = AL.rmse(test.join(means, "productId"), label="rating")
    return out.select(F.round("rmse", 6).alias("rmse"), "n")


def _i2v(spark, sf):
    return I2V.item2vec(Q.item_sequences(_r(spark, sf), ORDER))


def _emb_out(emb):
    return emb.select("productId", F.size("emb").alias("dims"), F.round(F.sqrt(V.dot(F.col("emb"), F.col("emb"))), 4).alias("norm"))


def _similar(spark, sf):
    model = _i2v(spark, sf)
    vocab = model.getVectors().select("word")
    # the most frequent positive item that made it into the vocabulary
    pos = _r(spark, sf).where(F.col("rating") >= 3.5).select(F.col("productId").cast("string").alias("word"))
    top = pos.join(vocab, "word").groupBy("word").count().orderBy(F.desc("count"), "word").first()["word"]
    return I2V.similar_items(model, top).select("word", F.round("similarity", 4).alias("similarity"))


def _ivf(spark, sf):
    vectors = fx.vectors(spark, sf)
    return IVF.neighbours(IVF.build(vectors), vectors, E.SIMILAR_K)


def _lsh_buckets(spark, sf):
    model, vec = I2V.lsh_model(fx.item_vectors(spark, sf))
    out = model.transform(vec)
    hashes = F.transform("bucketId", lambda v: vector_to_array(v)[0].cast("long").cast("string"))
    return out.select("productId", F.array_join(hashes, ",").alias("buckets"))


def _lsh_neighbours(spark, sf):
    model, vec = I2V.lsh_model(fx.item_vectors(spark, sf))
    key = fx.item_vectors(spark, sf).where("productId = 0").first()["emb"]
    return I2V.approx_neighbours(model, vec, [float(x) for x in key]).select("productId", F.round("distance", 6).alias("distance"))


def _sample_split(spark, sf, columns=("*",)):
    """Both parts of the samples, computed once; ``columns``: what is wanted of them beside the key."""
    wanted = columns if "*" in columns else [*KEY, *columns]
    split = stored(SP.hash_split(_samples(spark, sf).select(*wanted), KEY, seed=1), "split")
    return split.where("split = 'train'"), split.where("split = 'test'")


def _sample_job(spark, sf):
    """Write both sets as the job does, read them back."""
    path = f"{ensure_checkpoint_dir(spark)}/sample-job-{uuid.uuid4().hex}"
    parts = [IO.read_samples(spark, to).withColumn("split", F.lit(part))
             for part, to in save_train_test(_samples(spark, sf), path).items()]
    return parts[0].unionByName(parts[1]).select(*KEY, "label", "split", "productRatingCount",
                                                 _round("productAvgRating"), _round("userRatingStddev"))


def _save_by_time(spark, sf):
    """The sample job split by time: what the files of both parts hold."""
    path = f"{ensure_checkpoint_dir(spark)}/by-time-{uuid.uuid4().hex}"
    parts = [IO.read_samples(spark, to).withColumn("split", F.lit(part))
             for part, to in save_train_test(_samples(spark, sf), path, by_time=True, exact=True).items()]
    return parts[0].unionByName(parts[1]).select(*KEY, "label", "split")


def _damaged_samples(spark, sf):
    """Samples written as text lines of which a draw makes some short, long or unreadable, and some empty in a field."""
    path = f"{ensure_checkpoint_dir(spark)}/damaged-{uuid.uuid4().hex}"
    kind = F.pmod(draw(9, *(F.col(k) for k in KEY)), F.lit(20))
    fields = {f.name: F.col(f.name).cast("string") for f in IO.SAMPLE_SCHEMA.fields}
    fields["productAvgRating"] = F.when(kind == 2, "oops").otherwise(fields["productAvgRating"])
    fields["releaseYear"] = F.when(kind != 3, fields["releaseYear"])
    line = F.to_csv(F.struct(*(c.alias(n) for n, c in fields.items())))
    damaged = F.when(kind == 0, F.regexp_replace(line, ",[^,]*,[^,]*$", "")).when(kind == 1, F.concat(line, F.lit(",x"))).otherwise(line)
    _samples(spark, sf).select(damaged.alias("value")).write.text(path, compression="gzip")
    return path


def _ctr(spark, sf, kind):
    train, test = _sample_split(spark, sf)
    fitted = CTR.MODELS[kind](train, FL.frequent_types(train))
    return CTR.binary_metrics(spark, stored(CTR.predict(fitted, test).select("label", "p"), "scored"), kind)


def _field_slots(spark, sf):
    """The slots that each sample's ids and types set, of one vector with the numbers and the cross around them."""
    layout = [*FL.id_fields(), *FL.type_fields(FIXTURE_WORDS)]
    rows = FL.assemble(_samples(spark, sf), layout)
    own = F.filter(ENC.sparse_indices(F.col("features")), lambda i: (i >= 7) & (i < FL.offsets(layout, 7)[""]))
    return rows.select(*KEY, ENC.vector_size(F.col("features")).alias("width"), F.array_join(own, ",").alias("slots"))


def _als_rmse(spark, sf):
    model, _, test = _als(spark, sf)
    return AL.rmse(model.transform(test))


def _preview(spark, sf):
    train, test = _sample_split(spark, sf)
    return CTR.score_preview(CTR.predict(CTR.ctr_linear(train, FL.frequent_types(train)), test), ["userId", "timestamp", "productId"])


def _baseline_logloss(spark, sf):
    train, test = _sample_split(spark, sf, ["label"])
    rate = train.groupBy("productId").agg(F.avg("label").alias("p"))
    out = CTR.logloss_accuracy(test.join(rate, "productId"))
    return out.select(F.round("logloss", 6).alias("logloss"), F.round("accuracy", 6).alias("accuracy"), "n")


def _baseline_auc(spark, sf):
    """Areas under the curves of the products' own rates of positive labels, scores with many ties."""
    train, test = _sample_split(spark, sf, ["label"])
    rate = train.groupBy("productId").agg(F.avg("label").alias("p"))
    return CTR.exact_auc(test.join(rate, "productId")).select(_round("auc_roc"), _round("auc_pr"))


def _one_hot(spark, sf):
    enc = ENC.one_hot(fx.products(spark, sf), "productId", "v")
    return enc.select("productId", ENC.vector_size(F.col("v")).alias("size"),
                      F.coalesce(F.get(ENC.sparse_indices(F.col("v")), 0), F.lit(-1)).alias("idx"))


QUERIES: dict[str, Query] = {
    "training_samples": _samples,
    "minimum_slice": _minimum,
    # projections, filters, joins, aggregates
    "add_label": lambda s, sf: L.add_label(_r(s, sf)),
    "positive_only": lambda s, sf: L.positive_only(_r(s, sf)),
    "rating_histogram": lambda s, sf: L.rating_histogram(_r(s, sf)),
    "rating_count": lambda s, sf: _r(s, sf).agg(F.count(F.lit(1)).alias("n")),
    "product_attributes": lambda s, sf: fx.products(s, sf).select(
        "productId", SF.release_year("title").alias("releaseYear"), SF.clean_title("title").alias("cleanTitle"),
        *[SF.split_part("types", i).alias(f"productType{i + 1}") for i in range(3)]),
    "product_types": lambda s, sf: ENC.product_types(fx.products(s, sf)).select("productId", "type"),
    "ratings_with_products": lambda s, sf: P.join_products(_r(s, sf), fx.products(s, sf)),
    "product_rating_features": lambda s, sf: P.product_rating_features(_r(s, sf)),
    "product_stats": lambda s, sf: P.product_stats(_r(s, sf)).select(
        "productId", "ratingCount", _round("avgRating"), _round("ratingVar")),
    "distinct_users": lambda s, sf: AL.distinct_ids(_r(s, sf), "userId"),
    "typed_ratings": lambda s, sf: AL.typed_ratings(_r(s, sf)),
    "user_timeline": _timeline,
    # sequences
    "item_sequences": lambda s, sf: Q.item_sequences(_r(s, sf), ORDER).select("userId", "sentence", "productIdStr"),
    "item_sequences_short": lambda s, sf: Q.item_sequences(_r(s, sf), ORDER, max_len=4).select("userId", "sentence", "productIdStr"),
    "pair_counts": lambda s, sf: Q.pair_counts(_r(s, sf), ORDER),
    "transition_probs": lambda s, sf: Q.transition_probs(Q.pair_counts(_r(s, sf), ORDER)),
    "item_distribution": lambda s, sf: Q.item_distribution(Q.pair_counts(_r(s, sf), ORDER)),
    # embeddings
    "ratings_with_vectors": lambda s, sf: E.ratings_with_vectors(_r(s, sf), fx.item_vectors(s, sf)).select(
        *fx.ratings(s, sf).columns, F.size("emb").alias("dims"),
        F.round(F.sqrt(V.dot(F.col("emb"), F.col("emb"))), 6).alias("norm")),
    "user_embeddings": lambda s, sf: _user_emb(s, sf).select("userId", F.posexplode("emb").alias("dim", "value")).select(
        "userId", "dim", _round("value")),
    "nearest_k": lambda s, sf: E.nearest_k(fx.vectors(s, sf), E.query_vector(fx.vectors(s, sf), 0), 5).select(
        "vec_id", _round("distance")),
    "most_similar": lambda s, sf: E.most_similar(fx.vectors(s, sf), 0, 20).select("vec_id", _round("similarity")),
    "two_tower_scores": lambda s, sf: E.two_tower_scores(_r(s, sf), _user_emb(s, sf), fx.item_vectors(s, sf), 10).select(
        "userId", "productId", _round("score"), "rank"),
    "two_tower_new_items": lambda s, sf: E.two_tower_scores(
        E.next_item_candidates(_r(s, sf), Q.pair_counts(_r(s, sf), ORDER), fx.item_vectors(s, sf)),
        _user_emb(s, sf), fx.item_vectors(s, sf), 10).select(
        "userId", "productId", _round("score"), "rank"),
    "catalogue_top_items": lambda s, sf: CAT.catalogue_top_k(
        _user_emb(s, sf), fx.item_vectors(s, sf), 10, _r(s, sf).select("userId", "productId")).select(
        "userId", "productId", _round("score"), "rank"),
    "exact_neighbours": lambda s, sf: IVF.exact_neighbours(fx.vectors(s, sf), fx.vectors(s, sf), E.SIMILAR_K).select(
        "query", "id", _round("score"), "rank"),
    "ivf_neighbours": lambda s, sf: _ivf(s, sf).select("query", "id", _round("score"), "rank"),
    "window_counts": lambda s, sf: CO.window_counts(_r(s, sf), ORDER),
    "associations": lambda s, sf: CO.associations(CO.window_counts(_r(s, sf), ORDER)).select("a", "b", _round("w")),
    "fm_interaction": lambda s, sf: _distinct_pairs_with_fields(s, sf).select(
        "userId", "productId",
        F.round(F.aggregate(E.fm_interaction([F.col("a"), F.col("b")]), F.lit(0.0), lambda acc, x: acc + x), 4).alias("fm")),
    "pair_dots": lambda s, sf: _distinct_pairs_with_fields(s, sf).select(
        "userId", "productId",
        F.round(V.dot(F.col("b"), F.col("a")), 4).alias("item_user"),
        F.round(V.dot(F.col("b"), F.col("b")), 6).alias("item_item")),
    "fm_dimensions": _fm_dimensions,
    "four_dots": _four_dots,
    # encoders
    "one_hot": _one_hot,
    "type_index": lambda s, sf: ENC.index_types(ENC.product_types(fx.products(s, sf)))[0].select(
        "type", F.col("typeIndexInt").alias("typeIndex")).distinct(),
    "type_index_lists": lambda s, sf: ENC.type_index_lists(ENC.index_types(ENC.product_types(fx.products(s, sf)))[0]).select(
        "productId", F.array_join("typeIndexes", ",").alias("typeIndexes")),
    "vocabulary_size": lambda s, sf: ENC.vocabulary_size(ENC.index_types(ENC.product_types(fx.products(s, sf)))[0]),
    "multi_hot": lambda s, sf: ENC.multi_hot(fx.products(s, sf)).select(
        "productId", ENC.vector_size(F.col("vector")).alias("size"),
        F.array_join(ENC.sparse_indices(F.col("vector")), ",").alias("indices")),
    "minmax_avg_rating": lambda s, sf: ENC.minmax(P.product_stats(_r(s, sf)).select("productId", "avgRating"),
                                                  "avgRating", "scaledAvgRating").select(
        "productId", _round("avgRating"), _round("scaledAvgRating")),
    "bucket_and_scale": lambda s, sf: ENC.bucket_and_scale(P.product_stats(_r(s, sf))).select(
        "productId", "ratingCount", "ratingCountBucket",
        F.round(vector_to_array("scaleAvgRating")[0], 6).alias("scaleAvgRating")),
    "identity_index": lambda s, sf: _r(s, sf).select(
        "*", ENC.identity_index(F.col("productId"), ENC.PRODUCT_ID_BUCKETS).alias("productIdx"),
        ENC.identity_index(F.col("userId"), ENC.USER_ID_BUCKETS).alias("userIdx")),
    "vocab_index": lambda s, sf: ENC.product_types(fx.products(s, sf)).select(
        "productId", "type", ENC.vocab_index(F.col("type")).alias("vocabIndex")),
    "vocab_index_hits": lambda s, sf: ENC.product_types(fx.products(s, sf)).select(
        "productId", "type", ENC.vocab_index(F.col("type"), FIXTURE_WORDS).alias("vocabIndex")),
    "id_offenders": lambda s, sf: ENC.offenders(_r(s, sf), "productId", 100),
    "indicator": lambda s, sf: ENC.indicator(
        ENC.index_types(ENC.product_types(fx.products(s, sf)))[0], "typeIndexInt", 10, "v").select(
        "productId", "type", F.col("typeIndexInt").alias("typeIndex"),
        F.coalesce(F.get(ENC.sparse_indices(F.col("v")), 0), F.lit(-1)).cast("int").alias("hot")),
    "crossed": lambda s, sf: _samples(s, sf).select(
        "userId", "productId", "timestamp", "userRatedproduct1",
        ENC.crossed(F.col("productId"), F.col("userRatedproduct1")).alias("cross")),
    # sampling and splitting
    "split_samples": lambda s, sf: SP.hash_split(
        SP.hash_sample(_samples(s, sf), KEY, seed=0), KEY, seed=1).select("userId", "productId", "timestamp", "label", "split"),
    "sample_job": _sample_job,
    "samples_read": lambda s, sf: IO.read_samples(s, _damaged_samples(s, sf), header=False).select(
        *KEY, "label", "releaseYear", _round("productAvgRating"), "userType5"),
    "samples_skipped": lambda s, sf: IO.malformed_samples(s, _damaged_samples(s, sf), header=False),
    "save_by_time": _save_by_time,
    "time_split": lambda s, sf: SP.time_split(_samples(s, sf).select("userId", "productId", "timestamp", "label"),
                                              exact=True),
    "time_split_approx": lambda s, sf: SP.time_split(
        _samples(s, sf).select("userId", "productId", "timestamp", "label"), exact=False),
    "negative_items": lambda s, sf: SP.negative_items(_samples(s, sf).select(
        "userId", "productId", "timestamp", *[f"userRatedproduct{i}" for i in (2, 3, 4, 5)])),
    "random_walks": lambda s, sf: W.random_walks(s, Q.pair_counts(_r(s, sf), ORDER)).select(
        "walk_id", F.array_join("path", " ").alias("path"), F.size("path").alias("length")),
    # models and evaluation
    "als_user_recs": lambda s, sf: _rounded_recs(AL.user_recs(_als(s, sf)[0])),
    "als_item_recs": lambda s, sf: _rounded_recs(AL.item_recs(_als(s, sf)[0])),
    "als_user_subset_recs": lambda s, sf: _rounded_recs(_subset(s, sf, "userIdInt")),
    "als_item_subset_recs": lambda s, sf: _rounded_recs(_subset(s, sf, "productIdInt")),
    "als_rmse": _als_rmse,
    "als_cross_validation": lambda s, sf: AL.cross_validate(s, AL.model_input(_r(s, sf))[0]),
    "baseline_rmse": _baseline_rmse,
    "item2vec": lambda s, sf: _emb_out(I2V.embeddings_from_model(_i2v(s, sf))),
    "graph_embedding": lambda s, sf: _emb_out(I2V.embeddings_from_model(I2V.graph_embedding(
        W.random_walks(s, Q.pair_counts(_r(s, sf), ORDER))))),
    "cooccurrence_vectors": lambda s, sf: _emb_out(CO.item_vectors(CO.window_counts(_r(s, sf), ORDER))),
    "similar_items": _similar,
    "lsh_buckets": _lsh_buckets,
    "lsh_neighbours": _lsh_neighbours,
    "ctr_fm_metrics": lambda s, sf: _ctr(s, sf, "fm"),
    "ctr_mlp_metrics": lambda s, sf: _ctr(s, sf, "mlp"),
    "ctr_linear_metrics": lambda s, sf: _ctr(s, sf, "linear"),
    "ctr_trees_metrics": lambda s, sf: _ctr(s, sf, "trees"),
    "ctr_leaves_metrics": lambda s, sf: _ctr(s, sf, "leaves"),
    "ctr_score_preview": _preview,
    "baseline_auc": _baseline_auc,
    "field_slots": _field_slots,
    "baseline_logloss": _baseline_logloss,
    # what must hold of the models above
    "als_user_facts": lambda s, sf: facts.als_facts(s, sf, "userIdInt"),
    "als_item_facts": lambda s, sf: facts.als_facts(s, sf, "productIdInt"),
    "als_catalogue_facts": facts.als_catalogue_facts,
    "als_rmse_facts": facts.als_rmse_facts,
    "als_cv_facts": facts.als_cv_facts,
    "item2vec_facts": facts.item2vec_facts,
    "graph_embedding_facts": facts.graph_embedding_facts,
    "embedding_chain_facts": facts.embedding_chain_facts,
    "similar_items_facts": lambda s, sf: facts.similar_items_facts(s, sf, _similar(s, sf)),
    "cooccurrence_facts": facts.cooccurrence_facts,
    "walk_vector_facts": facts.walk_vector_facts,
    "ivf_facts": facts.ivf_facts,
    "lsh_facts": facts.lsh_facts,
    "bucket_facts": facts.bucket_facts,
    "time_split_facts": facts.time_split_facts,
    "sketch_facts": facts.sketch_facts,
    "ctr_facts": lambda s, sf: facts.ctr_facts(s, sf, _sample_split),
}

ORACLE: dict[str, str] = {
    "baseline_rmse": oracle.baseline_rmse_sql(),
    "baseline_logloss": oracle.baseline_logloss_sql(),
    "baseline_auc": oracle.baseline_auc_sql(),
    **oracle.sample_file_sql(),
    "field_slots": oracle.field_slots_sql(),
    "training_samples": oracle.training_samples_sql(),
    "minimum_slice": oracle.minimum_slice_sql(),
    **oracle.basic_sql(),
    **oracle.sequence_sql(),
    **oracle.embedding_sql(),
    **oracle.encoder_sql(),
    **oracle.split_sql(),
    "random_walks": oracle.walk_sql(),
    **oracle.fact_sql(),
}
