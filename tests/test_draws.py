"""Distribution of the draws, which an oracle with the same rule can't see."""

from pyspark.sql import functions as F

from recforge.functions.hashing import DRAWS, draw
from recforge.operators import encoders as ENC
from recforge.operators import splits as SP
from recforge.operators import walks as W


def chi2(counts, expected):
    return sum((c - expected) ** 2 / expected for c in counts)


def test_split_after_sample_has_both_parts(spark):
    df = spark.range(20000).select(F.col("id").alias("k"))
    kept = SP.hash_sample(df, ["k"], 0.1, seed=0)
    split = {r.split: r["count"] for r in SP.hash_split(kept, ["k"], 0.8, seed=1).groupBy("split").count().collect()}
    n = sum(split.values())
    assert 1800 < n < 2200 and 0.15 * n < split["test"] < 0.25 * n


def test_small_fractions(spark):
    df = spark.range(200000).select(F.col("id").alias("k"))
    assert 40 < SP.hash_sample(df, ["k"], 0.0004, seed=0).count() < 125
    assert SP.hash_sample(df, ["k"], 0.0).count() == 0 and SP.hash_sample(df, ["k"], 1.0).count() == 200000


def test_native_sample_and_split(spark):
    df = spark.range(10000)
    assert 800 < SP.downsample(df, 0.1, seed=3).count() < 1200
    train, test = SP.random_split(df, seed=3)
    assert train.count() + test.count() == 10000 and 1700 < test.count() < 2300
    assert train.intersect(test).count() == 0


def test_slots_of_negatives_are_independent(spark):
    df = spark.range(20000).select(F.col("id").alias("userId"), F.lit(1).alias("productId"), F.lit(2).alias("timestamp"),
                                   *[F.lit(None).cast("long").alias(f"userRatedproduct{s}") for s in (2, 3)])
    neg = SP.negative_items(df, slots=(2, 3))
    gap = F.pmod(F.col("negtive_userRatedproduct3") - F.col("negtive_userRatedproduct2"), F.lit(1001))
    assert neg.select(gap.alias("g")).distinct().count() > 990


def test_draws_are_uniform_and_steps_independent(spark):
    n, cells = 40000, 10
    d = spark.range(n).select(F.pmod(draw(0, F.col("id"), F.lit(1)), F.lit(cells)).alias("a"),
                              F.pmod(draw(0, F.col("id"), F.lit(2)), F.lit(cells)).alias("b"), draw(0, F.col("id"), F.lit(1)).alias("u"))
    pairs = [r["count"] for r in d.groupBy("a", "b").count().collect()]
    assert len(pairs) == cells * cells and chi2(pairs, n / cells ** 2) / (cells ** 2 - 1) < 1.5
    top = d.agg(F.max("u"), F.min("u")).first()
    assert 0 <= top[1] < DRAWS // 1000 and DRAWS - DRAWS // 1000 < top[0] < DRAWS


def test_cross_takes_large_ids(spark):
    df = spark.createDataFrame([(1 << 62, 5), (2_000_000_000, None), (-3, 1 << 61)], "a long, b long")
    got = [r[0] for r in df.select(ENC.crossed(F.col("a"), F.col("b"))).collect()]
    assert all(0 <= x < ENC.CROSS_BUCKETS for x in got)


def test_walks_reach_every_source_beyond_2_33(spark):
    pairs = spark.createDataFrame([(s, 100 + t, 1 << 32) for s in range(8) for t in range(4)], "src long, dst long, cnt long")
    walks = W.random_walks(spark, pairs, n_walks=2000, length=2, seed=1)
    firsts = {r[0]: r[1] for r in walks.groupBy(F.col("path")[0]).count().collect()}
    seconds = {r[0]: r[1] for r in walks.groupBy(F.col("path")[1]).count().collect()}
    assert set(firsts) == set(range(8)) and chi2(firsts.values(), 250) / 7 < 3
    assert set(seconds) == {100, 101, 102, 103} and chi2(seconds.values(), 500) / 3 < 4


def test_walks_are_markov(spark):
    """Where a walk goes from an item doesn't depend on how it got there."""
    pairs = spark.createDataFrame([(a, b, 1) for a in range(4) for b in range(4)], "src long, dst long, cnt long")
    walks = W.random_walks(spark, pairs, n_walks=8000, length=3, seed=2)
    triples = [r["count"] for r in walks.groupBy(F.col("path")[0], F.col("path")[1], F.col("path")[2]).count().collect()]
    assert len(triples) == 64 and chi2(triples, 8000 / 64) / 63 < 1.6


def test_hot_items_are_split_without_changing_a_walk(spark):
    pairs = spark.createDataFrame([(0, b, b + 1) for b in range(1, 40)] + [(b, 0, 2) for b in range(1, 38)], "src long, dst long, cnt long")
    plain = sorted(map(str, W.random_walks(spark, pairs, n_walks=300, length=5, seed=4).collect()))
    split = sorted(map(str, W.random_walks(spark, pairs, n_walks=300, length=5, seed=4, rows=7, keep=2).collect()))
    assert plain == split


def test_a_step_exchanges_walkers_only(spark):
    pairs = spark.createDataFrame([(a, b, 1 + a) for a in range(30) for b in range(9)], "src long, dst long, cnt long")
    index = W.lay(W.line(pairs, block=4), "test")
    walkers = spark.range(40).select((F.col("id") % 30).alias("g"), F.col("id").alias("w"), F.col("id").alias("draw"))
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        step = W.take(walkers, index, block=4, crowded=False)
        plan = step._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
    assert len(scans) == 2 and "Python" not in plan and "Pandas" not in plan
    assert sum("Exchange" in line for line in lines) == 2
    for i in scans:  # nothing is exchanged between a scan and the join above it
        above = [line for line in lines[:i]]
        depth = [len(line) - len(line.lstrip(" :+-|")) for line in lines]
        d, path = depth[i], []
        for k in range(i - 1, -1, -1):
            if depth[k] < d:
                path.append(above[k])
                d = depth[k]
            if "Join" in above[k] and depth[k] <= d:
                break
        assert path and not any("Exchange" in line for line in path)


def test_a_walker_takes_the_interval_of_its_draw(spark):
    counts = {(a, b): 1 + (a * 7 + b * 3) % 5 for a in (3, 2_000_000_000, 1 << 40) for b in range(0, 40, 1 + a % 3)}
    pairs = spark.createDataFrame([(*k, n) for k, n in counts.items()], "src long, dst long, cnt long")
    walkers = [(a, 1000 * i + d, d) for i, a in enumerate((3, 2_000_000_000, 1 << 40, 77)) for d in range(150)]
    want = {}
    for a, w, d in walkers:
        line = [b for (s, b), n in sorted(counts.items()) if s == a for _ in range(n)]
        if line:
            want[w] = line[d % len(line)]
    at = spark.createDataFrame(walkers, "g long, w long, draw long")
    for block, rows in ((1, 10 ** 6), (3, 40), (4096, 1)):
        got = W.take(at, W.lay(W.line(pairs, block=block), "test"), rows=rows, block=block).collect()
        assert len(got) == len(want) and {r.w: r.item for r in got} == want
    none = W.random_walks(spark, pairs.where("cnt < 0"), n_walks=5)
    assert none.columns == ["walk_id", "path"] and none.collect() == []


def test_exact_quantile(spark):
    for values in ([1, 1, 1, 1, 9], list(range(11)), [5], [None, 3, 4]):
        df = spark.createDataFrame([(v,) for v in values], "timestamp long")
        rows = df.select(F.expr("percentile_disc(0.8) WITHIN GROUP (ORDER BY timestamp)")).first()[0]
        assert df.select(SP.exact_time_quantile(df)).first()[0] == rows
