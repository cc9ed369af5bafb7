"""SimHash near-duplicates: fingerprints within a radius, compared bit-sliced.

Only distinct fingerprints are compared, so exact copies cost nothing.  The 64
bits are cut into five parts; two fingerprints that differ in at most two bits
agree in three parts or more, so each fingerprint is sent to the ten buckets
named by three of its parts.

A bucket's members are stored as bit planes: plane p holds bit p of all members
side by side, 64 members to a machine word.  One member is compared with all by
exclusive-or with its own bits, and the differences are added up in carry-save
counters of one bit plane each (ones, twos, and a plane that stays set once a
count passes the radius).  A block of members is abandoned as soon as all of its
counts have passed.

A bucket of more than ``FULL`` members is split: its members agree in 38 bits or
more, so the 26 other bits are cut into three parts and two members within the
radius agree in one of them.  Should such a bucket be full as well, its members
are dealt to blocks, and each pair of blocks is compared in a task of its own.
Links leave a bucket as a spanning forest, never as all pairs.

Nulls: a null text has no words; its fingerprint is zero, linked like any other.  A
null id never names a component unless there is no other.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm.components import components

RADIUS = 2
SHINGLE = 3  # words
SEED = 42
FULL = 1024  # members of a bucket that one task compares
ENDS = (0, 13, 26, 39, 52, 64)  # parts of the 64 bits


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the hashes of a text's shingles; 0 for a text without words."""
    import xxhash
    words = text.lower().split()  # bytes: only A-Z are lowered, only white space of ASCII separates
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())],
                 "<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        set_bits += np.unpackbits(h[at:at + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(h), bitorder="little").view("<u8")[0])


_FP = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp) for each row: a hash of the text, and the fingerprint as a signed long."""
    def run(doc_id, h, text):
        data, at = C.flat(text)
        raw = data.tobytes()
        fps = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.uint64)
        return {"doc_id": doc_id, "h": h, "fp": pa.array(fps.view(np.int64))}

    return C.texts(docs).select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        C.by_batch(run, _FP, "doc_id", "h", "text"), "doc_id bigint, h bigint, fp bigint")


def planes(fps: np.ndarray) -> np.ndarray:
    """64 bit planes of the fingerprints, 64 members to a word."""
    size = -(-len(fps) // 64) * 64
    bits = np.zeros((size, 64), np.uint8)
    bits[:len(fps)] = np.unpackbits(fps.astype("<u8")[:, None].view(np.uint8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def near(queries: np.ndarray, sliced: np.ndarray, radius: int = RADIUS, block: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, member) pairs within the radius (at most 2), for ``block`` machine words of members at a time."""
    assert 0 <= radius <= 2
    ask = np.unpackbits(queries.astype("<u8")[:, None].view(np.uint8), axis=1, bitorder="little").astype(bool)
    for lo in range(0, sliced.shape[1], block):
        part = sliced[:, lo:lo + block]
        alive = np.arange(len(queries))  # queries whose block isn't abandoned
        ones = np.zeros((len(queries), part.shape[1]), np.uint64)
        twos, past = ones.copy(), ones.copy()
        for p in range(64):
            differ = part[p] ^ np.where(ask[alive, p], np.uint64(2**64 - 1), np.uint64(0))[:, None]
            carry = ones & differ
            ones ^= differ
            past |= twos & carry
            twos ^= carry
            if p % 4 == 3:
                over = past if radius == 2 else past | twos if radius == 1 else past | twos | ones
                if radius == 2:
                    over = past | (ones & twos)
                going = ~(over == np.uint64(2**64 - 1)).all(1)
                if not going.all():
                    alive, ones, twos, past = alive[going], ones[going], twos[going], past[going]
                if not len(alive):
                    break
        if len(alive):
            over = past | (ones & twos) if radius == 2 else past | twos if radius == 1 else past | twos | ones
            found = np.unpackbits(np.ascontiguousarray(~over).astype("<u8").view(np.uint8), axis=1, bitorder="little")
            q, m = np.nonzero(found)
            yield alive[q], m + 64 * lo


def forest(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs over 0..n-1."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist()):
            u, v = root(x), root(y)
            if u != v:
                parent[max(u, v)] = min(u, v)
                edges.append((x, y))
    return edges


def compare(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among ``left``, or between it and ``right``, as a spanning forest."""
    fps = left if right is None else np.concatenate([left, right])
    target = planes(left if right is None else right)
    shift = 0 if right is None else len(left)
    size = len(left) if right is None else len(right)

    def pairs():
        for at in range(0, len(left), 256):
            for q, m in near(left[at:at + 256], target, radius):
                q = q + at
                ok = (m < size) & ((m > q) if right is None else True)
                yield q[ok], m[ok] + shift

    edges = forest(len(fps), pairs())
    a, b = np.array([e[0] for e in edges], np.int64), np.array([e[1] for e in edges], np.int64)
    return fps[a], fps[b]


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.uint64).view(np.int64)) for x in (a, b)], schema=_EDGE)


def within_buckets(rows: DataFrame, radius: int) -> DataFrame:
    """Edges among the members (fp) of each bucket (t, key); a bucket holds at most ``FULL``."""
    def run(batches):
        waiting_key, waiting = None, []
        for batch in batches:
            t, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            change = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            out_a, out_b = [], []
            for lo, hi in zip([0, *change], [*change, len(t)]):
                if waiting_key != (t[lo], key[lo]):
                    if sum(map(len, waiting)) > 1:
                        for out, x in zip((out_a, out_b), compare(np.concatenate(waiting), None, radius)):
                            out.append(x)
                    waiting_key, waiting = (t[lo], key[lo]), []
                waiting.append(fp[lo:hi].view(np.uint64))
            if out_a:
                yield _edges(np.concatenate(out_a), np.concatenate(out_b))
        if sum(map(len, waiting)) > 1:
            yield _edges(*compare(np.concatenate(waiting), None, radius))

    return rows.select("t", "key", "fp").repartition("t", "key").sortWithinPartitions("t", "key", "fp") \
        .mapInArrow(run, "a bigint, b bigint")


def between_blocks(rows: DataFrame, sizes: DataFrame, radius: int, full: int) -> DataFrame:
    """Edges in buckets of any size: members dealt to blocks, each pair of blocks a group of its own."""
    sizes = sizes.withColumn("blocks", F.ceil(F.col("n") / (full // 2)).cast("int"))
    dealt = rows.join(sizes, ["t", "key"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")) \
        .select("t", "key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .select("t", "key", "fp", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))

    def pair(table: pa.Table) -> pa.Table:
        fp, block = table["fp"].to_numpy().view(np.uint64), table["block"].to_numpy()
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        a, b = compare(fp, None, radius) if x == y else compare(fp[block == x], fp[block == y], radius)
        return pa.Table.from_batches([_edges(a, b)])

    return dealt.groupBy("t", "key", "x", "y").applyInArrow(pair, "a bigint, b bigint")


def part(fp, lo: int, hi: int):
    """Bits [lo, hi) of a long column."""
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def bucket_keys(radius: int):
    """Masks whose bits two fingerprints within the radius share, for one of them at least."""
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(ENDS, ENDS[1:])]
    return [sum(c) for c in combinations(parts, len(parts) - radius)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def split_mask(mask: int, radius: int) -> list[int]:
    """``mask`` with each of radius + 1 shares of the bits outside it."""
    rest = [i for i in range(64) if not mask >> i & 1]
    shares = [rest[k::radius + 1] for k in range(radius + 1)]
    return [mask | sum(1 << i for i in share) for share in shares]


def keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """A row (t, key, fp) for each mask t: the bits of fp that the mask selects."""
    pairs = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                      for t, m in enumerate(masks)))
    return fps.select("fp", F.inline(pairs)).select("t", "key", "fp")


def links(fps: DataFrame, radius: int = RADIUS, full: int = FULL) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (distinct ``fp``) which links within the radius do.

    Buckets are counted first, with one row a bucket and task shuffled, so no
    member of a hot bucket travels under its key.
    """
    masks, edges = bucket_keys(radius), []
    rows = keyed(fps, masks)
    for level in range(2):
        sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
        sizes = C.written(sizes, "buckets")
        small = rows.join(sizes.where(F.col("n") <= full), ["t", "key"])
        edges.append(within_buckets(small, radius))
        hot = sizes.where(F.col("n") > full)
        if hot.isEmpty():
            break
        if level == 1:
            edges.append(between_blocks(rows, hot, radius, full))
            break
        inside = rows.join(hot.select("t", "key"), ["t", "key"], "left_semi")
        # Within a hot bucket its mask's bits are the same, so a finer mask is a bucket of its own.
        fine = [(t, m) for t, mask in enumerate(masks) for m in split_mask(mask, radius)]
        options = F.array(*(F.struct(F.lit(t).alias("of"), F.lit(i).alias("t"), F.lit(signed(m)).alias("mask"))
                            for i, (t, m) in enumerate(fine)))
        rows = inside.select("fp", F.explode(F.filter(options, lambda o: o.of == F.col("t"))).alias("o")) \
            .select(F.col("o.t").alias("t"), F.col("fp").bitwiseAND(F.col("o.mask")).alias("key"), "fp")
    out = edges[0]
    for more in edges[1:]:
        out = out.unionAll(more)
    return out


def grouped(fps: DataFrame, radius: int = RADIUS, full: int = FULL) -> DataFrame:
    """(fp, component, component_id) of a written table (doc_id, fp): the component's least
    fingerprint, and the least doc_id that links reach."""
    nodes = C.written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    parts = components(links(nodes.select("fp"), radius, full)).withColumnRenamed("node", "fp")
    tied = nodes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = tied.groupBy("component").agg(F.min("first").alias("component_id"))
    return tied.join(least, "component").select("fp", "component", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, all columns as they are."""
    fps = C.written(fingerprints(docs, shingle), "fingerprints")
    return one_of_each(docs, fps.join(grouped(fps, radius), "fp"))


def one_of_each(docs: DataFrame, tied: DataFrame) -> DataFrame:
    """One row of each component, all columns as they are: that of the least id (a null id comes last),
    of rows with one id that of the least text hash, and any one of repeated rows.  ``tied`` has
    (doc_id, h, component) for each row."""
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    members = tied.groupBy("component", "doc_id", "h").agg(F.count("*").alias("rows"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "rows")
    chosen = members.groupBy("component").agg(F.min(first).alias("c")).select("c.doc_id", "c.h", "c.rows")
    chosen = C.written(chosen, "chosen")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("doc_id"), h.alias("h"))

    def of(some: DataFrame) -> DataFrame:
        return rows.join(some, rows["doc_id"].eqNullSafe(some["doc_id"]) & (rows["h"] == some["h"])) \
            .select("row", rows["doc_id"], rows["h"])

    once = of(chosen.where("rows = 1")).select("row.*")
    more = chosen.where("rows > 1")
    if more.isEmpty():
        return once
    return once.unionByName(of(more).groupBy("doc_id", "h").agg(F.first("row").alias("row")).select("row.*"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for each row."""
    fps = C.written(fingerprints(docs, shingle), "fingerprints")
    return fps.join(grouped(fps, radius), "fp").select("doc_id", "fp", "component_id")
