"""Benchmark decontamination by greedy string tiling.

Seeds: every rolling hash of ``k`` words of a document is joined to the same
hash of a benchmark item.  Seeds on one diagonal in a row make a match, so the
matches of a document and an item of k words or more are known from the seeds.
Tiling repeatedly takes the longest match whose words nobody has marked yet and
marks them, cutting what remains of overlapping ones, until none of k words is
left.  An item is found in a document if the marked share of the item's words
reaches ``coverage``; the order of the passages doesn't matter.

Equal hashes of 64 bits are taken for equal words.  An item of fewer than k words is
sought by seeds of its own length, whole; an item without words is never found.

Nulls: a null text is empty; null ids are ordinary values.  Repeated rows each
get their row.  Very long texts are hashed whole; their seeds with an item are one row.  Empty
tables: no item is found.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm import grams

K = 5  # words
COVERAGE = 0.8
SMALL = 64 << 20  # bytes of seeds that are sent to every executor; more are joined by a shuffle

_GRAMS = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("n_words", pa.int64()), ("grams", pa.list_(pa.int64()))])
GRAMS_DDL = "id bigint, h bigint, n_words bigint, grams array<bigint>"


def hashed(rows: DataFrame, k: int) -> DataFrame:
    """(id, h, n_words, grams) of (id, h, text): the hash of the k-gram that starts at each word."""
    def run(batches):
        for batch in batches:
            data, bounds = C.flat(batch.column(2))
            at = 0
            for part, ends in grams.chunks(data, bounds):
                words, n_words = grams.word_hashes(part, ends)
                h, n = grams.gram_hashes(words, n_words, k)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                                 pa.array(h.view(np.int64)))
                ids = [batch.column(i).slice(at, len(n)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(n_words), lists], schema=_GRAMS)
                at += len(n)

    return rows.mapInArrow(run, GRAMS_DDL)


def tile(pos: np.ndarray, item_pos: np.ndarray, k: int = K) -> list[tuple[int, int, int]]:
    """Greedy tiles (place, place in the item, words) from the seeds of a document and an item."""
    order = np.lexsort((pos, pos - item_pos))
    pos, item_pos = pos[order], item_pos[order]
    new = np.ones(len(pos), bool)
    new[1:] = (np.diff(pos) != 1) | (np.diff(item_pos) != 1)
    first = np.flatnonzero(new)
    lengths = np.diff(np.append(first, len(pos))) + k - 1
    heap = [(-int(n), int(item_pos[i]), int(pos[i])) for i, n in zip(first, lengths)]
    heapq.heapify(heap)
    marked, item_marked, tiles = set(), set(), []
    while heap:
        n, t, p = heapq.heappop(heap)
        free = [p + i not in marked and t + i not in item_marked for i in range(-n)]
        if all(free):
            tiles.append((p, t, -n))
            marked.update(range(p, p - n))
            item_marked.update(range(t, t - n))
            continue
        at = None  # what is left of the match goes back, if it is long enough
        for i, f in enumerate([*free, False]):
            if f and at is None:
                at = i
            elif not f and at is not None:
                if i - at >= k:
                    heapq.heappush(heap, (at - i, t + at, p + at))
                at = None
    return tiles


FOUND_DDL = "doc_id bigint, h bigint, item_id bigint, coverage double, tiles array<struct<pos:int,item_pos:int,n:int>>"


def matches(docs: DataFrame, benchmark: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, h, item_id, coverage, tiles) of the pairs with a seed; h is the hash of the document's text."""
    keyed = C.texts(docs).select("doc_id", F.xxhash64("text").alias("h"), "text")
    items = C.texts(benchmark, "item_id").select("doc_id", F.xxhash64("text").alias("h"), "text").distinct()
    sizes = hashed(items, 1).select(F.least("n_words", F.lit(k)).alias("size")).distinct().collect()  # k + 1 at most
    found = [matches_of_size(keyed, items, size, k) for size in sorted({r["size"] for r in sizes} - {0}) or [k]]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def matches_of_size(keyed: DataFrame, items: DataFrame, k: int, full: int) -> DataFrame:
    """The matches of the items of k words, or, for the full seed length, of k words or more."""
    own = F.col("n_words") >= k if k == full else F.col("n_words") == k
    seeds = hashed(items, k).where(own).select(F.col("id").alias("item_id"), F.col("h").alias("item_h"), F.col("n_words").alias("item_words"),
                                    F.posexplode("grams").alias("item_pos", "gram"))
    seeds = C.written(seeds, "seeds")
    if seeds.count() * 64 <= SMALL:
        seeds = F.broadcast(seeds)
    hits = hashed(keyed, k).select("id", "h", F.posexplode("grams").alias("pos", "gram")).join(seeds, "gram")
    # A set, so that the seeds of repeated rows are merged in the tasks that find them.
    pairs = hits.groupBy(F.col("id").alias("doc_id"), "h", "item_id", "item_h", "item_words") \
        .agg(F.collect_set(F.struct("pos", "item_pos")).alias("seeds"))

    def run(batches):
        for batch in batches:
            out = []
            for d, h, i, n, seeds in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                           for c in ("doc_id", "h", "item_id", "item_words", "seeds"))):
                tiles = tile(np.array([s["pos"] for s in seeds]), np.array([s["item_pos"] for s in seeds]), k)
                out.append({"doc_id": d, "h": h, "item_id": i, "coverage": sum(t[2] for t in tiles) / n,
                            "tiles": [dict(zip(("pos", "item_pos", "n"), t)) for t in tiles]})
            yield pa.RecordBatch.from_pylist(out, schema=_FOUND)

    return pairs.mapInArrow(run, FOUND_DDL)


_FOUND = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()),
                    ("tiles", pa.list_(pa.struct([("pos", pa.int32()), ("item_pos", pa.int32()), ("n", pa.int32())])))])


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = K, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, h, items, coverage) of the contaminated documents: the items found, and the largest coverage."""
    return matches(docs, benchmark, k).where(F.col("coverage") >= coverage).groupBy("doc_id", "h") \
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage"))


def same_row(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["h"] == right["h"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = K, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, contaminated, items, coverage) for each row."""
    found = leaks(docs, benchmark, k, coverage)
    rows = C.texts(docs).select("doc_id", F.xxhash64("text").alias("h"))
    return rows.join(found, same_row(rows, found), "left").select(
        rows["doc_id"], F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def clean(docs: DataFrame, benchmark: DataFrame, k: int = K, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are."""
    found = leaks(docs, benchmark, k, coverage).select("doc_id", "h")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("doc_id"),
                       F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("h"))
    return rows.join(found, same_row(rows, found), "left_anti").select("row.*")
