"""What must not grow: rows as wide as a vector, partial sums as serialized objects, parsing done again for a filter."""

from pyspark.sql import functions as F

from recforge.operators import embeddings as E

RATINGS = "userId bigint, productId bigint"
VECTORS = "productId bigint, emb array<float>"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_user_sums_are_plain_aggregates(spark):
    ratings = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 7), (2, 9), (3, 9), (None, 6)], RATINGS)
    items = spark.createDataFrame([(5, [1.0, 2.0]), (6, [0.5, -1.0]), (7, None), (8, [9.0, 9.0])], VECTORS)
    users = E.user_embeddings(ratings, items)
    assert {r["userId"]: r["emb"] for r in users.collect()} == {1: [2.5, 3.0], None: [0.5, -1.0]}
    assert "ObjectHashAggregate" not in plan(users) and "Summarizer" not in plan(users)


def test_pairs_without_an_item_vector_leave_before_vectors_join(spark):
    pairs = spark.createDataFrame([(1, 5), (1, 7), (2, 6)], RATINGS)
    items = spark.createDataFrame([(5, [1.0, 2.0]), (6, [0.5, -1.0]), (8, [9.0, 9.0])], VECTORS)
    users = spark.createDataFrame([(1, [1.0, 1.0]), (2, [2.0, 0.0])], "userId bigint, emb array<double>")
    scored = E.two_tower_scores(pairs, users, items)
    assert {(r[0], r[1], r["score"]) for r in scored.collect()} == {(1, 5, 3.0), (2, 6, 1.0)}
    assert "LeftSemi" in plan(scored)


def test_a_sample_line_is_parsed_once(spark, scratch):
    from recforge.sources import files as IO
    spark.range(1).select(F.lit("1,2,x").alias("value")).write.text(f"{scratch}/lines")
    assert IO.read_samples(spark, f"{scratch}/lines")._jdf.queryExecution().optimizedPlan().toString().count("from_csv") <= 1


def test_product_statistics_join_before_the_window(spark):
    """The wide rows that leave the window are never dealt again by product."""
    from recforge.plans.registry import _samples
    from .conftest import SF_SMALL
    tree = _samples(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = {w: min(i for i, line in enumerate(tree) if w in line) for w in ("Window [", "Join ")}
    assert at["Window ["] < at["Join "]


def test_model_input_is_read_from_a_checkpoint(spark):
    from recforge.operators import als as AL
    from recforge.sources import fixtures as fx
    from .conftest import SF_SMALL
    ratings = fx.ratings(spark, SF_SMALL)
    for narrow, wide in zip(AL.model_input(ratings), AL.train_test(ratings)):
        columns = ["userIdInt", "productIdInt", "ratingFloat"]
        assert narrow.columns == columns and "Join" not in plan(narrow)
        assert narrow.exceptAll(wide.select(columns)).count() == 0 == wide.select(columns).exceptAll(narrow).count()


def test_a_query_is_sent_once_a_slab(spark):
    from recforge.operators import ivf
    slabs = ivf.in_slabs({0: 10, 1: 2 * ivf.SLAB, 2: 5}, {0: 1, 1: 4, 2: 1})
    assert slabs == {0: [0], 1: [0, 0, 1, 1], 2: [2]}
    rows = spark.createDataFrame([(7, [1.0], [0, 1, 2])], "id bigint, vec array<double>, cells array<int>")
    assert sorted(r["slab"] for r in ivf.with_slabs(rows, slabs).collect()) == [0, 1, 2]  # six parts


def test_a_pair_gets_both_vectors_from_one_exchange(spark):
    ratings = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (1, 7), (2, 7), (2, 9), (3, 9), (None, 6), (4, None), (4, 8)], RATINGS)
    items = spark.createDataFrame([(5, [1.0, 2.0]), (6, [0.5, -1.0]), (6, [2.0, 2.0]), (7, None), (8, [9.0, 9.0]), (None, [1.0, 1.0])], VECTORS)
    rows = E.rated_pairs_with_vectors(ratings, items)
    users = E.user_embeddings(ratings, items).withColumnRenamed("emb", "a")
    want = ratings.distinct().join(items.withColumnRenamed("emb", "b"), "productId").join(users, "userId").select(rows.columns)
    assert rows.schema["a"].dataType == want.schema["a"].dataType
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect())) and rows.count() == 5
    assert E.rated_pairs_with_vectors(ratings, items.where("emb is null")).count() == 0


def test_pair_vectors_are_dealt_once_and_as_they_are(spark):
    """Neither sums nor their terms, twice as wide as a vector, are below the one exchange by user."""
    from recforge.plans.registry import _distinct_pairs_with_fields
    from .conftest import SF_SMALL
    tree = _distinct_pairs_with_fields(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    above, below = tree.split("RepartitionByExpression")
    assert tree.count("Join ") == 2 and "sum(" in above and "sum(" not in below and "_w0" not in below


def test_a_matrix_product_sums_numbers(spark):
    from recforge.operators import cooccurrence as CO
    matrix = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5), (2, 2, 2.0), (3, 1, 1.0), (1, 3, 1.0)], "a bigint, b bigint, w double")
    factors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [3.0, -1.0]), (3, [0.0, 4.0])], "id bigint, vec array<double>")
    product = CO.times(matrix, factors, 2)
    assert {r["id"]: r["vec"] for r in product.collect()} == {1: [1.5, 3.5], 2: [6.5, -2.0], 3: [1.0, 0.0]}
    assert "ObjectHashAggregate" not in plan(product)


def test_recommendations_do_not_join_all_pairs(spark):
    """Neither side's factors are crossed with the other's, and the rows are those of Spark's search, floats and all."""
    from recforge.operators import als as AL
    rows = [(u, p, float((u * 7 + p * 3) % 10) / 2 + 0.5) for u in range(30) for p in range(50) if (u + p) % 3]
    model = AL.fit_als(spark.createDataFrame(rows, "userIdInt int, productIdInt int, ratingFloat float"))
    for recs, plain, key, other in ((AL.user_recs, model.recommendForAllUsers, "userIdInt", "productIdInt"),
                                    (AL.item_recs, model.recommendForAllItems, "productIdInt", "userIdInt")):
        got, want = recs(model), AL.explode_recs(plain(10), key, other)
        assert "CartesianProduct" not in plan(got) and "CartesianProduct" in plan(want)
        both = got.withColumnRenamed("rating", "_r").join(want, [key, other, "rank"], "full")
        assert got.dtypes == want.dtypes and both.where("rating is null or _r is null or abs(rating - _r) > 1e-5").count() == 0


def test_click_features_compile_and_are_read_from_a_checkpoint(spark, monkeypatch):
    """No method of a scoring plan is beyond the 8,000 bytes of bytecode that the JVM compiles; a fit reads two columns."""
    from recforge.operators import ctr as CTR
    from recforge.operators import fields as FL
    from .test_clicks import samples
    train = samples(spark, [(k % 20, k % 15, k % 2, k % 7 / 2, k % 5 / 2, "red") for k in range(200)]).checkpoint()
    fields = [*FL.id_fields(), *FL.type_fields([f"word{i}" for i in range(18)])]
    read = []

    class Machine(CTR.FMClassifier):
        def fit(self, dataset, params=None):
            read.append((dataset.columns, plan(dataset)))
            return super().fit(dataset, params)

    model = CTR._fit(train, Machine(labelCol="label", featuresCol="features", maxIter=2, seed=1), fields, cross=True)
    ((columns, tree),) = read
    assert columns == ["label", "features"] and tree.strip().startswith("*(1) Scan ExistingRDD")
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    code = debug.codegenStringSeq(CTR.predict(model, train)._jdf.queryExecution().executedPlan())
    sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    assert len(sizes) > 2 and max(sizes) <= 8000


def test_facts_fit_the_trees_once(spark, monkeypatch):
    from recforge.operators import ctr as CTR
    from recforge.plans import facts
    from .test_clicks import samples
    fits = []
    plain = CTR.ctr_trees
    counted = lambda *a, **kw: fits.append(1) or plain(*a, trees=2, depth=2, **kw)
    monkeypatch.setattr(CTR, "ctr_trees", counted)
    monkeypatch.setattr(CTR, "MODELS", {"trees": counted, "leaves": lambda *a, **kw: CTR.ctr_leaves(*a, depth=2, **kw)})
    rows = samples(spark, [(k % 20, k % 15, k % 2, k % 7 / 2, k % 5 / 2, "red") for k in range(200)]).checkpoint()
    got = {r.fact: r.value for r in facts.ctr_facts(spark, "", lambda *_: (rows, rows)).collect()}
    assert got["trees_scored"] == got["leaves_scored"] == 200 and len(fits) == 1
