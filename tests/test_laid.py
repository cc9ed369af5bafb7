"""Arrays in files: numbering, parts that cut an id's rows, the factorization in them, and what isn't exchanged."""

import os

import numpy as np
import pytest

from recforge.operators import cooccurrence as CO
from recforge.operators import embeddings as E
from recforge.operators import item2vec as I2V
from recforge.operators import als as AL
from recforge.operators import laid


def test_numbered(spark):
    ids, n = laid.numbered(spark.createDataFrame([(5,), (None,), (-2,), (5,), (10 ** 12,)], "a bigint").repartition(3), "a")
    assert n == 3 and {(r.a, r["at"]) for r in ids.collect()} == {(-2, 0), (5, 1), (10 ** 12, 2)}


def test_lay_keeps_every_row_in_order(spark):
    rows = [(k % 7 if k % 10 else 3, float(k), [k, -k]) for k in range(300)]
    df = spark.createDataFrame(rows, "at bigint, x double, s array<int>").repartition(5)
    parts = laid.lay(df, 300, "at", {"at": np.int64, "x": np.float64, "s": np.int32}, laid.folder(spark, "test"), size=32)
    got = []
    for p in parts:
        with np.load(p.path) as f:
            assert 0 < len(f["at"]) <= 32 and (np.diff(f["at"]) >= 0).all() and (p.lo, p.hi) == (f["at"][0], f["at"][-1])
            got += [(int(a), float(x), s.tolist()) for a, x, s in zip(f["at"], f["x"], f["s"])]
    assert sorted(got) == sorted(rows) and [p.lo for p in parts[1:]] >= [p.hi for p in parts[:-1]]


@pytest.mark.parametrize("part", [1 << 17, 9])  # small parts cut a row of the matrix
def test_factorization_of_cut_rows(spark, part):
    rng = np.random.default_rng(4)
    own = rng.normal(size=(30, 3))
    m = own @ own.T
    entries = [(a * 11 - 5, b * 11 - 5, float(m[a, b])) for a in range(30) for b in range(30)]
    df = spark.createDataFrame(entries, "a bigint, b bigint, w double").repartition(4)
    got = {r["id"]: r["vec"] for r in CO.factorize(df, size=3, extra=4, part=part).collect()}
    vecs = np.array([got[a * 11 - 5] for a in range(30)])
    assert vecs.shape == (30, 3) and np.allclose(vecs @ vecs.T, m, atol=1e-6)


def test_a_step_exchanges_nothing(spark):
    """The steps run no shuffle: the only jobs of a step are those of ``each_part``, on the files."""
    plan = CO.factorize(spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "a bigint, b bigint, w double"), size=1)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_vectors_of_a_model_are_files_and_not_on_the_driver(spark):
    words = spark.createDataFrame([(["1", "2", "3"] * 5,)] * 4, "productIds array<string>")
    emb = I2V.embeddings_from_model(I2V.item2vec(words, iterations=1, partitions=1))
    assert "LocalTableScan" not in emb._jdf.queryExecution().executedPlan().toString() and emb.count() == 3


def test_other_items_leave_before_ratings_are_grouped(spark):
    ratings = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, 9), (None, 7)], "userId bigint, productId bigint")
    emb = spark.createDataFrame([(7, [1.0, 2.0]), (8, None)], "productId bigint, emb array<float>")
    users = E.user_embeddings(ratings, emb)
    assert {(r.userId, tuple(r.emb)) for r in users.collect()} == {(1, (2.0, 4.0)), (None, (1.0, 2.0))}
    plan = users._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_blocks_of_als():
    assert AL.blocks_for(0) == {"numUserBlocks": 10, "numItemBlocks": 10}
    assert AL.blocks_for(10_000_001)["numItemBlocks"] == 11
