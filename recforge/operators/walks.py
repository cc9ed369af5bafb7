"""Random walks over the item transition graph.

Semantics: a walk's first item is drawn from the start distribution (each
source item weighted by its outgoing pair count, sources in id order); each
next item is drawn from the current item's outgoing pairs (weighted by
count, targets in id order); a walk stops early at an item without outgoing
pairs.  The draw of a walk and a step is a 60-bit hash of (seed, walk, step):
``u = draw mod total`` picks the first interval whose cumulative count exceeds
``u``, so there is no floating-point gap at the end of a distribution.

Plan shape: the pairs are laid once as an index of two bucketed tables, and a
step joins the walkers to it, so only walkers are exchanged in a step.

* one running sum over all pairs in the order (source, target), range by range
  (``prefix_sum``), gives every pair its interval of one line; a source's pairs
  are a stretch of that line, however many they are;
* consecutive intervals of a source, at most ``BLOCK``, are one row of the table
  of blocks, bucketed by (source, block);
* a source's row in the directory, bucketed by source, has its stretch and the
  ends of its blocks;
* a walker finds its block in the directory's row and its interval in the
  block's row by binary search: two joins on keys, and no Python;
* walkers of a source with more than ``rows`` of them are dealt to copies of that
  source's part of the index;
* a step's walkers are checkpointed, and walks are put together once at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recforge.functions.hashing import draw
from recforge.operators.prefix import RANGE_PARTS, prefix_sum
from recforge.sources.tables import scratch_table

N_WALKS = 20000    # walks generated
WALK_LENGTH = 10   # items per walk at most
GROUP_ROWS = 1_000_000  # walkers of one source that share a group
BLOCK = 4096       # intervals of a block
KEEP_STEPS = 1     # steps between checkpoints


def line(pairs: DataFrame, parts: int = RANGE_PARTS, block: int = BLOCK) -> DataFrame:
    """(g, item, cnt, hi, _p, blk): the pairs as intervals [hi - cnt, hi) in the order of (source, target),
    with their range and their block, of at most ``block`` intervals that follow each other in one range."""
    placed = prefix_sum(pairs.select(F.col("src").cast("long").alias("g"), F.col("dst").cast("long").alias("item"),
                                     F.col("cnt").cast("long").alias("cnt")), ["g", "item"], "cnt", parts=parts)
    place = F.row_number().over(Window.partitionBy("_p").orderBy("g", "item")) - 1
    return placed.withColumn("blk", F.shiftleft(F.col("_p").cast("long"), 33) + F.floor(place / block))


def lay(intervals: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The index of intervals (g, item, cnt, hi, _p, blk): the directory (g, lo, total, ends, blks) and the
    blocks (g, blk, ends, items), both bucketed tables in the checkpoint folder."""
    spark = intervals.sparkSession
    parts = F.array_sort(F.collect_list(F.struct("hi", "item")))
    blocks = intervals.groupBy("_p", "g", "blk").agg(parts.alias("s"), F.min(F.col("hi") - F.col("cnt")).alias("lo")) \
        .select("g", "blk", "lo", F.array_max("s.hi").alias("end"), F.col("s.hi").alias("ends"), F.col("s.item").alias("items"))
    blocks = scratch_table(spark, blocks, f"{name}_blocks", ["g", "blk"])
    heads = blocks.groupBy("g").agg(
        F.min("lo").alias("lo"), F.max("end").alias("end"), F.array_sort(F.collect_list(F.struct("end", "blk"))).alias("s"))
    directory = heads.select("g", "lo", (F.col("end") - F.col("lo")).alias("total"), F.col("s.end").alias("ends"),
                             F.col("s.blk").alias("blks"))
    return scratch_table(spark, directory, f"{name}_directory", ["g"]), blocks.drop("lo", "end")


def first_above(ends: str, u: str, at_most: int = 1 << 31) -> Column:
    """The position in the sorted array ``ends``, of at most so many, of the first that is above ``u``."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((at_most - 1).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(ends, at + step - 1) <= F.col(u), at + step).otherwise(at))


def look_up(walkers: DataFrame, directory: DataFrame, blocks: DataFrame, also: list[str], block: int) -> DataFrame:
    """(w, item) of walkers (g, w, draw) by the index; ``also`` are further columns that all three share."""
    placed = walkers.join(directory, ["g", *also]).withColumn("u", F.col("lo") + F.pmod("draw", "total"))
    found = placed.select("g", *also, "w", "u", F.get("blks", first_above("ends", "u")).alias("blk"))
    return found.join(blocks, ["g", *also, "blk"]).select("w", F.get("items", first_above("ends", "u", block)).alias("item"))


def take(walkers: DataFrame, index: tuple[DataFrame, DataFrame], rows: int = GROUP_ROWS, block: int = BLOCK,
         crowded: bool = True) -> DataFrame:
    """(w, item): each walker (g, w, draw) takes the first interval of its group that ends above the draw
    modulo the group's total; one in a group without intervals has no row.

    ``crowded`` says that a group may have more than ``rows`` walkers; it needn't be counted if there are no more in all.
    """
    if not crowded:
        return look_up(walkers, *index, [], block)
    # At most one row for each ``rows`` walkers.
    crowds = F.broadcast(walkers.groupBy("g").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
                         .select("g", F.ceil(F.col("_n") / rows).cast("int").alias("_copies")))
    copied = [t.join(crowds, "g").select(*t.columns, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
              for t in index]
    dealt = walkers.join(crowds, "g").select(*walkers.columns, F.pmod("w", "_copies").cast("int").alias("_copy"))
    return look_up(walkers.join(crowds, "g", "left_anti"), *index, [], block).unionByName(
        look_up(dealt, *copied, ["_copy"], block))


def random_walks(
    spark: SparkSession,
    pairs: DataFrame,
    n_walks: int = N_WALKS,
    length: int = WALK_LENGTH,
    seed: int = 0,
    parts: int = RANGE_PARTS,
    rows: int = GROUP_ROWS,
    keep: int = KEEP_STEPS,
) -> DataFrame:
    """walk_id, path (array<long>, 1..length items).  Building the plan runs the jobs of the steps."""
    block, crowded = min(BLOCK, rows), n_walks > rows
    index = lay(line(pairs, parts, block), "walks")
    # Sources by the range and block of their last pair, so that a group is bounded as ranges and blocks are.
    last = F.element_at("blks", -1)
    sources = index[0].select(F.shiftright(last, 33).alias("g"), F.shiftright(last, 33).alias("_p"), F.col("g").alias("item"),
                              F.col("total").alias("cnt"), (F.col("lo") + F.col("total")).alias("hi"), last.alias("blk"))
    starts = lay(sources, "starts")
    grand = index[0].agg(F.max(F.col("lo") + F.col("total"))).scalar()
    # Lower bounds of the ranges, sorted: one entry for each.
    bounds = starts[0].agg(F.array_sort(F.collect_list(F.struct("lo", F.col("g").alias("p"))))).scalar()
    first = spark.range(n_walks).select(F.col("id").alias("w"), F.pmod(draw(seed, F.col("id"), F.lit(0)), grand).alias("u"),
                                        bounds.alias("_bounds"))
    first = first.select("w", "u", F.element_at(F.filter("_bounds", lambda b: b["lo"] <= F.col("u")), -1).alias("_b")) \
        .where("_b is not null").select(F.col("_b.p").alias("g"), "w", (F.col("u") - F.col("_b.lo")).alias("draw"))
    cur = take(first, starts, rows, block, crowded).checkpoint()
    steps = [cur]
    for k in range(1, length):
        at = cur.select(F.col("item").alias("g"), "w", draw(seed, F.col("w"), F.lit(k)).alias("draw"))
        cur = take(at, index, rows, block, crowded)
        if k % keep == 0 or k + 1 == length:
            cur = cur.checkpoint()
        steps.append(cur)
    every = reduce(DataFrame.unionByName, [s.withColumn("k", F.lit(k)) for k, s in enumerate(steps)])
    return every.groupBy(F.col("w").alias("walk_id")).agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("s")) \
        .select("walk_id", F.col("s.item").alias("path"))
