"""Hand-made edge rows (FIXTURES.md §3) for every operator with a fixed rule."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recforge.functions import scalar as SF
from recforge.functions.arrays import rank_by_frequency
from recforge.functions.hashing import draw, uniform_excluding
from recforge.functions.vectors import fm_pairwise
from recforge.operators import embeddings as E
from recforge.operators import encoders as ENC
from recforge.operators import sequences as Q
from recforge.operators.history import add_user_features
from recforge.operators.labels import add_label
from recforge.operators.products import join_products, product_rating_features
from recforge.plans.samples import training_samples

RATINGS = "userId long, productId long, rating double, ts long"


def test_time_sort(spark):
    df = spark.createDataFrame([(1, 1, 4.0, 1112486027), (1, 2, 4.0, 1212546032), (1, 3, 4.0, 1012486033)], RATINGS)
    row = Q.item_sequences(df).collect()[0]
    assert row["productIds"] == ["3", "1", "2"]
    assert row["productIdStr"] == "3 1 2"


def test_sentences_split_long_sequences(spark):
    df = spark.createDataFrame([(1, i, 5.0, i) for i in range(25)], RATINGS)
    rows = sorted(Q.item_sequences(df, max_len=10).collect(), key=lambda r: r["sentence"])
    assert [len(r["productIds"]) for r in rows] == [10, 10, 5]
    assert rows[2]["productIds"][0] == "20"


def _pairs(spark, seqs):
    rows = [(u, item, 5.0, t) for u, seq in enumerate(seqs) for t, item in enumerate(seq)]
    df = spark.createDataFrame(rows, RATINGS) if rows else spark.createDataFrame([], RATINGS)
    return {(r["src"], r["dst"]): r["cnt"] for r in Q.pair_counts(df).collect()}


def test_pairs(spark):
    assert _pairs(spark, [[858, 50, 593, 457]]) == {(858, 50): 1, (50, 593): 1, (593, 457): 1}
    assert _pairs(spark, [[7]]) == {}
    assert _pairs(spark, [[7, 7]]) == {(7, 7): 1}


def test_transitions(spark):
    a, b, c = 1, 2, 3
    pairs = spark.createDataFrame([(a, b, 3), (a, c, 1), (b, a, 1)], "src long, dst long, cnt long")
    probs = {(r.src, r.dst): r.prob for r in Q.transition_probs(pairs).collect()}
    assert probs == {(a, b): 0.75, (a, c): 0.25, (b, a): 1.0}
    dist = {r.item: r.prob for r in Q.item_distribution(pairs).collect()}
    assert dist == {a: 0.8, b: 0.2}


def test_type_rank(spark):
    df = spark.createDataFrame([(["A", "B", "C", "D", "E", "F", "D"],), ([],)], "w array<string>")
    out = [r[0] for r in df.select(rank_by_frequency(F.col("w"))).collect()]
    assert out == [["D", "A", "B", "C", "E", "F"], []]


def test_release_year_and_title(spark):
    df = spark.createDataFrame([(None,), ("",), ("ab",), ("  X (1999) ",), ("X (abcd)",)], "t string")
    years = [r[0] for r in df.select(SF.release_year("t")).collect()]
    assert years == [1990, 1990, 1990, 1999, 1990]
    assert spark.createDataFrame([("  X (1999) ",)], "t string").select(SF.clean_title("t")).first()[0] == "X"


def test_split_types_and_label(spark):
    df = spark.createDataFrame([("A|B",), (None,)], "types string")
    rows = df.select(*[SF.split_part("types", i) for i in range(3)]).collect()
    assert [tuple(r) for r in rows] == [("A", "B", None), (None, None, None)]
    lab = spark.createDataFrame([(3.5,), (3.4,), (None,)], "rating double").select(SF.label("rating")).collect()
    assert [r[0] for r in lab] == [1, 0, 0]


def test_product_absent_and_one_rating(spark):
    ratings = spark.createDataFrame([(1, 99, 4.0, 1)], RATINGS)
    products = spark.createDataFrame([(1, "X (2001)", "A|B")], "productId long, title string, types string")
    row = join_products(ratings, products).first()
    assert row["releaseYear"] == 1990 and row["productType1"] is None
    feats = product_rating_features(ratings).first()
    assert feats["productRatingCount"] == 1 and feats["productRatingStddev"] == "0.00"


def _history(spark, n_events, rating=5.0, history=100, chunk=None):
    ratings = spark.createDataFrame([(1, 10 + i, rating, i) for i in range(n_events)], RATINGS)
    products = spark.createDataFrame([(10 + i, f"P (200{i % 10})", "A|B") for i in range(n_events)],
                                      "productId long, title string, types string")
    return training_samples(ratings, products, ("ts", "productId"), history=history, rows_per_chunk=chunk)


def test_short_history(spark):
    assert [_history(spark, n).count() for n in (1, 2, 3)] == [0, 0, 1]


def test_long_history(spark):
    rows = _history(spark, 103).orderBy("timestamp").collect()
    assert rows[-1]["userRatingCount"] == 100
    assert rows[-1]["userRatedproduct1"] == 10 + 101


def test_no_positives(spark):
    row = _history(spark, 4, rating=1.0).orderBy("timestamp").collect()[-1]
    assert [row[f"userRatedproduct{i}"] for i in range(1, 6)] == [None] * 5
    assert [row[f"userType{i}"] for i in range(1, 6)] == [None] * 5


def test_history_excludes_current_event(spark):
    for row in _history(spark, 30, history=5).collect():
        hist = [row[f"userRatedproduct{i}"] for i in range(1, 6)]
        assert row["productId"] not in hist
        assert row["userRatingCount"] <= 5


def test_multi_hot_repeat(spark):
    products = spark.createDataFrame([(1, "t", "A|A|B"), (2, "t", "B")], "productId long, title string, types string")
    rows = {r.productId: r.idx for r in ENC.multi_hot(products).select(
        "productId", ENC.sparse_indices(F.col("vector")).alias("idx")).collect()}
    assert len(rows[1]) == 2 and rows[1] == sorted(rows[1])


def test_negatives(spark):
    df = spark.createDataFrame([(0,), (1000,), (None,), (5000,)], "own long")
    h = draw(2020, F.lit(12345), F.lit(2))
    rows = df.select("own", uniform_excluding(h, F.coalesce(F.col("own"), F.lit(0)), 1001).alias("neg")).collect()
    for r in rows:
        assert 0 <= r.neg <= 1000
        assert r.neg != (r.own if r.own is not None else 0)


def test_unknown_type(spark):
    df = spark.createDataFrame([("Unknown",), ("Gold",), (None,)], "t string")
    idx = [r[0] for r in df.select(ENC.vocab_index(F.col("t"))).collect()]
    assert idx == [-1, 11, -1]


def test_embedding_sum(spark):
    ratings = spark.createDataFrame([(1, 7, 5.0, 1), (1, 7, 1.0, 2), (1, 8, 3.0, 3)], RATINGS)
    emb = spark.createDataFrame([(7, [1.0, 2.0]), (8, [10.0, 20.0])], "productId long, emb array<float>")
    assert E.user_embeddings(ratings, emb).first()["emb"] == [12.0, 24.0]


def test_fm_term(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0])], "a array<double>, b array<double>")
    assert df.select(fm_pairwise([F.col("a"), F.col("b")])).first()[0] == [6.0, 16.0]


def test_label_column(spark):
    df = spark.createDataFrame([(1, 1, 3.5, 1)], RATINGS)
    assert add_label(df).first()["label"] == 1


def test_add_user_features_drops_types(spark):
    out = _history(spark, 5)
    assert "types" not in out.columns and "userType1" in out.columns


def test_white_space_around_titles(spark):
    df = spark.createDataFrame([("X (1999)\r",), ("\tY (2001) \u00a0",), ("Z (1987)",)], "t string")
    rows = df.select(SF.release_year("t").alias("y"), SF.clean_title("t").alias("c")).collect()
    assert [tuple(r) for r in rows] == [(1999, "X"), (2001, "Y"), (1987, "Z")]


def test_followers_without_a_vector_are_no_candidates(spark):
    """Item 4 follows what user 1 rated but has no vector, item 5 has a null one: neither is joined to users."""
    ratings = spark.createDataFrame([(1, 1), (2, 3), (2, 1)], "userId long, productId long")
    pairs = spark.createDataFrame([(1, 2, 3), (1, 3, 1), (1, 4, 1), (1, 5, 1), (3, 1, 2)], "src long, dst long, n long")
    vectors = spark.createDataFrame([(1, [1.0]), (2, [1.0]), (3, [1.0]), (5, None)], "productId long, emb array<float>")
    found = E.next_item_candidates(ratings, pairs, vectors).collect()
    assert sorted((r.userId, r.productId) for r in found) == [(1, 2), (1, 3), (2, 2)]
