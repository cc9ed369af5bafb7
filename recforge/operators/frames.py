"""Row-bounded windows that stay balanced when one key holds a huge share of rows.

A window ``partitionBy(key).orderBy(...).rowsBetween(-P, F)`` puts every row
of a key into one task.  If one user owns a third of all events that task
owns a third of the data.  Frames bounded in rows only need the P rows before
and the F rows after each row, so a hot key is cut into chunks of consecutive
rows, each windowed on its own beside copies of the P rows before it and the F
rows after it.

1. One partial aggregate counts the rows of each key; keys (a null one too) with
   more than ``rows_per_chunk`` are hot.
2. Rows of hot keys are dealt to ranges of (key, order), so a row's position in
   its key is its number within the range plus the rows of the key in the ranges
   before.  The order is the whole order key, not its first column: rows that
   share a time are cut as well.
3. Row number p is in chunk p // rows_per_chunk, and is copied, flagged as
   context, to the other chunks that have a row in [p - F, p + P].

The caller windows over ``partitionBy(key, "_chunk")`` and drops rows with
``_ctx``.  Rows of other keys are in chunk 0 and aren't copied.  Results are those
of the plain window for any threshold, if the order is total.

Building the plan runs the counting job, and, if there is a hot key, one that
checkpoints the hot keys' rows once they are dealt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
CTX = "_ctx"

# Default size of a chunk of a hot key, in rows.
DEFAULT_ROWS_PER_CHUNK = 2_000_000


def hot_keys(df: DataFrame, key: str, rows_per_chunk: int) -> DataFrame:
    """(_key, _n) of the keys with more rows than a chunk, counted and checkpointed."""
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows_per_chunk).checkpoint()


def hot_positions(df: DataFrame, hot: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """The rows of hot keys with ``_pos``, their 0-based position in the key, and ``_n``, the key's rows."""
    rows = df.join(hot, df[key].eqNullSafe(hot["_key"])).drop("_key")
    ranged = rows.repartitionByRange(key, *order_cols).withColumn("_range", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_of")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_key", "_of", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy(key, "_range").orderBy(*order_cols)) - 1
    numbered = ranged.withColumn("_own", own)
    same = numbered[key].eqNullSafe(starts["_key"]) & (numbered["_range"] == starts["_of"])
    return numbered.join(starts, same).withColumn("_pos", F.col("_start") + F.col("_own")) \
        .select(*df.columns, "_pos", "_n")


def _parts(df: DataFrame, key: str, order_cols: Sequence[str], rows_per_chunk: int | None, counted: DataFrame | None):
    """Rows of other keys, and numbered rows of hot keys or None."""
    if rows_per_chunk is None:
        return df, None
    hot = hot_keys(df if counted is None else counted, key, rows_per_chunk)
    if hot.isEmpty():
        return df, None
    return df.join(hot, df[key].eqNullSafe(hot["_key"]), "left_anti"), hot_positions(df, hot, key, order_cols)


def chunk_frames(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    preceding: int,
    following: int = 0,
    rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``_chunk`` and ``_ctx`` so that windows over (key, _chunk) with a
    frame of at most ``preceding`` rows before and ``following`` rows after
    give the same values as over key alone.

    ``counted``, if given, is a cheaper table with at least ``df``'s rows for each key, on which hot keys are found.
    """
    cold, placed = _parts(df, key, order_cols, rows_per_chunk, counted)
    out = cold.withColumn(CHUNK, F.lit(0).cast("long")).withColumn(CTX, F.lit(False))
    if placed is None:
        return out
    chunk = lambda pos: F.floor(pos / F.lit(rows_per_chunk))
    lo = chunk(F.greatest(F.col("_pos") - following, F.lit(0)))
    hi = chunk(F.least(F.col("_pos") + preceding, F.col("_n") - 1))
    own = chunk(F.col("_pos"))
    copies = placed.withColumn(CHUNK, F.explode(F.sequence(lo, F.greatest(own, hi)))).withColumn(CTX, F.col(CHUNK) != own)
    return out.unionByName(copies.select(*df.columns, CHUNK, CTX))


def key_positions(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK,
    name: str = "_pos",
) -> DataFrame:
    """0-based position of each row within its key, in ``order_cols`` order; no task numbers a hot key alone."""
    cold, placed = _parts(df, key, order_cols, rows_per_chunk, None)
    own = F.row_number().over(Window.partitionBy(key).orderBy(*order_cols)) - 1
    out = cold.select(*df.columns, own.cast("long").alias(name))
    return out if placed is None else out.unionByName(placed.select(*df.columns, F.col("_pos").alias(name)))
