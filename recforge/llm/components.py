"""Connected components of a graph given as a table of edges.

Alternates two steps until nothing changes: every node tells its larger
neighbours of its smallest one, and then its smaller neighbours.  Each halves
long chains, so rounds grow with the logarithm of the longest path.  Every round
is written to the shared folder, and the folder before it is no longer needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _linked(to_least: DataFrame, links: DataFrame) -> DataFrame:
    """Each link's far end tied to the least of the near end.  A hot node is one row on the side of
    ``to_least``, so Spark can split its links."""
    return links.join(to_least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")) \
        .where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``edges`` (a long, b long); a component is named by its least node.

    No edges: no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = written(edges, "edges")
    before = None
    while True:
        both = _both(edges)
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        larger = _linked(least, both.where("b > a").unionAll(least.select("a", F.col("a").alias("b"))))
        smaller = larger.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = smaller.groupBy("a").agg(F.min("b").alias("least"))
        edges = written(_linked(least, smaller.unionAll(smaller.select("a", F.col("a").alias("b")))), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
