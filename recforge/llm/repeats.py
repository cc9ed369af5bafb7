"""Removal of long repeated byte strings, by prefix-free parsing.

Every window of ``N`` bytes that also starts elsewhere in the corpus is found:

1. Parsing.  In each window the rolling hashes of its ``W``-byte strings have a
   least one, the leftmost if several are equal: the window's trigger.  It
   depends on the window's bytes alone, so equal windows have the same trigger at the
   same place.  Consecutive starts with one trigger make a phrase; with the bytes
   that its last window looks ahead, it is an entry of the dictionary.
2. A phrase whose trigger string occurs nowhere else can't hold a repeated window.
   That needs only the triggers' hashes and leaves most of a corpus behind.
3. Dictionary.  What is left is reduced to distinct entries with their numbers of
   occurrences in the parse.  Windows of an entry that occurs twice are repeated.
4. Order.  Suffixes of the entries of one trigger are put side by side by the hash of
   their first N bytes; equal neighbours are compared byte by byte.  The
   parse gives their multiplicities.  (Equality on N bytes is all that removal needs, so the order is
   by hash and not by alphabet.)  Entries of a trigger with more than ``FULL`` of
   them are never gathered: they are cut into smaller and smaller pieces, and equal pieces are counted.
5. What the parse says of each text is put together, and covered bytes are cut out.

Texts take part once, however many rows hold them; a text of N bytes or more
that two rows hold is repeated as a whole.  Hashes of texts are 64 bits
wide, those of entries and pieces 128; they are taken for what they hash.

Nulls: a null text has no bytes.  Repeated rows are copies of each other.  Empty
table: no rows.  Texts are named by 64-bit hashes; different texts of one hash are found by
their SHA-256 and named by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm import grams

N = 200  # bytes of a repeated string
W = 48  # bytes of a trigger string
FULL = 64  # entries of one trigger that one task puts in order
WIDTHS = (16, 4, 1)  # windows of the pieces into which entries of other triggers are cut
_CHUNK = 1 << 19  # bytes for which hashes are kept at a time, of one text or several
_STEP = 1 << 18  # windows that are hashed together, so that tables of powers have one size
_PLACE = np.uint64((1 << 24) - 1)


def byte_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on; a window's hash is its own, wherever it stands."""
    out = np.empty(max(0, len(data) - size + 1), np.uint64)
    up, down = grams.powers(_STEP + N), grams.powers(_STEP + N, pow(grams._BASE, -1, 1 << 64))
    for at in range(0, len(out), _STEP):
        part = data[at:at + _STEP + size - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(grams._BYTE[part] * up[:len(part)], dtype=np.uint64, out=sums[1:])
        out[at:at + _STEP] = grams.spread((sums[size:] - sums[:-size]) * down[:len(sums) - size])
    return out


def parse(data: np.ndarray, bounds: np.ndarray, n: int = N, w: int = W) -> tuple[np.ndarray, ...]:
    """(start, length, trigger hash, trigger's distance) of the phrases of rows laid end to end; a phrase is a
    run of window starts, and the distance is from its first one."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(data) < n:
        return none
    h = byte_hashes(data, w)
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)  # the hash first, then the place
    width = 1
    while 2 * width <= n - w + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = n - w + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    trigger = (least & _PLACE).astype(np.int64)
    depth = np.zeros(len(data) + 1, np.int64)  # window starts lie in [start of a row, end - n]
    fits = np.diff(bounds) >= n
    np.add.at(depth, bounds[:-1][fits], 1)
    np.add.at(depth, bounds[1:][fits] - n + 1, -1)
    starts = np.flatnonzero(np.cumsum(depth)[:len(trigger)] > 0)
    if not len(starts):
        return none
    own = trigger[starts]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return starts[first], np.diff(np.append(first, len(starts))), h[own[first]], own[first] - starts[first]


def parsed(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
    """(row, starts, lengths, triggers, distances) of each row with a phrase; starts are places in the row."""
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + _CHUNK, side="right")) - 1)
        part, ends = data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]
        if len(part) > _CHUNK:  # one long row, in slices that share what windows look ahead
            found = [(at, *parse(x, np.array([0, len(x)]))) for at in range(0, len(part) - N + 1, _CHUNK)
                     for x in [part[at:at + _CHUNK + N - 1]]]
            starts, lengths, triggers, leads = (np.concatenate(x) for x in zip(*((s + at, *x) for at, s, *x in found)))
        else:
            starts, lengths, triggers, leads = parse(part, ends)
        row = np.searchsorted(ends, starts, side="right") - 1
        for r, a, b in zip(*(x.tolist() for x in runs(row))):
            yield lo + r, starts[a:b] - ends[r], lengths[a:b], triggers[a:b], leads[a:b]
        lo = hi


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, from, to) of the stretches of equal values."""
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[at], at, np.append(at[1:], len(x))


_PARSE = pa.schema([("tid", pa.int64()), ("phrases", pa.list_(pa.struct([
    ("start", pa.int64()), ("n", pa.int32()), ("trigger", pa.int64()), ("lead", pa.int32())])))])


def phrases(rows: DataFrame) -> DataFrame:
    """(tid, start, n, trigger, lead) of every phrase of (tid, text)."""
    def run(batches):
        for batch in batches:
            ids, out, ends, parts = batch.column(0).to_numpy(), [], [0], []
            for r, starts, lengths, triggers, leads in parsed(*C.flat(batch.column(1))):
                out.append(ids[r])
                parts.append((starts, lengths.astype(np.int32), triggers.view(np.int64), leads.astype(np.int32)))
                ends.append(ends[-1] + len(starts))
            if out:
                structs = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)],
                                                     fields=list(_PARSE.field(1).type.value_type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)], schema=_PARSE)

    return rows.mapInArrow(run, "tid bigint, phrases array<struct<start:bigint,n:int,trigger:bigint,lead:int>>") \
        .select("tid", F.inline("phrases"))


_ENTRY = pa.schema([("tid", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("trigger", pa.int64()), ("lead", pa.int32()),
                    ("entry", pa.binary()), ("raw", pa.binary())])
_ENTRY_DDL = "tid bigint, start bigint, n int, trigger bigint, lead int, entry binary, raw binary"


def entries(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """A row for each wanted phrase (tid, phrases) with its bytes and their 128-bit digest."""
    def run(batches):
        for batch in batches:
            for tid, text, found in zip(*batch.columns):  # a row's phrases at a time
                tid, data, found = tid.as_py(), text.as_py().encode(), found.as_py()
                raw = [data[p["start"]:p["start"] + p["n"] - 1 + N] for p in found]
                digest = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(
                        ([tid] * len(raw), *([p[k] for p in found] for k in ("start", "n", "trigger", "lead")), digest, raw),
                        _ENTRY)], schema=_ENTRY)

    def packed(batches):  # Spark's rows would go out one small batch a text; gather them
        waiting, rows = [], 0
        for batch in run(batches):
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= 4096:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, rows = [], 0
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return texts.join(wanted, "tid").select("tid", "text", "phrases").mapInArrow(packed, _ENTRY_DDL)


def windows(raws: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entries' bytes end to end; entry, place and hash of each of their windows."""
    data = np.frombuffer(b"".join(raws), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(r) for r in raws])])[:-1]
    entry = np.repeat(np.arange(len(raws)), lengths)
    place = np.arange(len(entry)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + at[entry]
    return data, entry, place, byte_hashes(data, N)[place]


def same_bytes(data: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the N bytes at x and at y are equal, pair by pair, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    out, left = np.ones(len(x), bool), np.arange(len(x))
    for i in [*range(0, N - 8, 8), N - 8]:
        same = (eight[x[left] + i] == eight[y[left] + i]).all(1)
        out[left[~same]] = False
        left = left[same]
    return out


def repeated(raws: list[bytes], lengths: np.ndarray, counts: np.ndarray) -> list[list[list[int]]]:
    """For each entry the ranges [from, to) of its window starts that are repeated among the entries."""
    data, entry, place, h = windows(raws, lengths)
    order = np.argsort(h, kind="stable")
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(h[a] == h[b])
    near = near[same_bytes(data, place[a[near]], place[b[near]])]
    found = counts[entry] > 1
    found[a[near]] = found[b[near]] = True
    return ranges(found, lengths)


def ranges(found: np.ndarray, lengths: np.ndarray) -> list[list[list[int]]]:
    out, at = [], 0
    for n in lengths.tolist():
        value, lo, hi = runs(found[at:at + n])
        out.append([[int(a), int(b)] for v, a, b in zip(value, lo, hi) if v])
        at += n
    return out


_MARKS = pa.schema([("entry", pa.binary()), ("ranges", pa.list_(pa.list_(pa.int32())))])
_MARKS_DDL = "entry binary, ranges array<array<int>>"


def marked_in_order(dictionary: DataFrame) -> DataFrame:
    """(entry, ranges) of the entries, all of a trigger in one task, at most ``FULL`` of them."""
    def run(batches):
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch])
            trigger = table["trigger"].to_numpy()
            cut = int(np.searchsorted(trigger, trigger[-1]))  # the last trigger may go on in the next batch
            if cut:
                yield from solve(table.slice(0, cut))
            left = table.slice(cut)
        if left is not None:
            yield from solve(left)

    def solve(table):
        """Whole triggers, in bounded numbers of bytes."""
        trigger, size = table["trigger"].to_numpy(), np.cumsum(table["n"].to_numpy() + N, dtype=np.int64)
        lo = 0
        while lo < len(trigger):
            hi = len(trigger)
            if size[-1] > size[lo] + _CHUNK:
                past = trigger[int(np.searchsorted(size, size[lo] + _CHUNK))]
                hi = int(np.searchsorted(trigger, past)) if past != trigger[lo] else int(np.searchsorted(trigger, past, side="right"))
            yield from solve_together(table.slice(lo, hi - lo))
            lo = hi

    def solve_together(table):
        marks = repeated(table["raw"].to_pylist(), table["n"].to_numpy(), table["count"].to_numpy())
        keep = [i for i, m in enumerate(marks) if m]
        if keep:
            yield pa.RecordBatch.from_arrays([table["entry"].combine_chunks().take(pa.array(keep)),
                                              pa.array([marks[i] for i in keep], _MARKS.field(1).type)], schema=_MARKS)

    return dictionary.select("trigger", "entry", "raw", "n", "count").repartition("trigger") \
        .sortWithinPartitions("trigger").mapInArrow(run, _MARKS_DDL)


_PIECES = pa.schema([("entry", pa.binary()), ("at", pa.int32()), ("n", pa.int32()), ("lead", pa.int32()),
                     ("piece", pa.binary()), ("raw", pa.binary()), ("count", pa.int64())])
_PIECES_DDL = "entry binary, at int, n int, lead int, piece binary, raw binary, count bigint"


def pieces_of(dictionary: DataFrame, width: int) -> DataFrame:
    """Entries cut into pieces of at most ``width`` windows, at distances from the trigger that are the same in
    all entries, so that what entries share becomes equal pieces."""
    def cut(entry, raw, n, lead, count):
        out = {k: [] for k in _PIECES.names}
        for e, r, m, d, c in zip(*(x.to_pylist() for x in (entry, raw, n, lead, count))):
            a = 0
            while a < m:
                b = min(m, a + (d - a) % width + 1)  # d - a, the distance to the trigger, shrinks along the entry
                part = r[a:b - 1 + N]
                for k, v in zip(_PIECES.names, (e, a, b - a, d - a, hashlib.blake2b(part, digest_size=16).digest(), part, c)):
                    out[k].append(v)
                a = b
        return out

    return dictionary.mapInArrow(C.by_batch(cut, _PIECES, "entry", "raw", "n", "lead", "count"), _PIECES_DDL)


def marked_by_count(dictionary: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(entry, ranges) of any number of entries of a trigger, none of which are gathered.

    Entries are cut into pieces, and equal pieces counted, summed in tasks before the shuffle.
    A piece that occurs twice is repeated as a whole.  The distinct pieces are
    cut again, down to single windows, and what that says of a piece that occurs once goes back to its entry.
    """
    width, *finer = widths
    pieces = C.written(pieces_of(dictionary, width), "pieces")
    distinct = C.written(pieces.groupBy(F.col("piece").alias("entry")).agg(
        F.first("raw").alias("raw"), F.first("n").alias("n"), F.first("lead").alias("lead"), F.sum("count").alias("count")), "distinct")
    marks = distinct.where("count > 1").select(F.col("entry").alias("piece"), F.array(F.array(F.lit(0), "n")).alias("ranges"))
    if finer:
        once = distinct.where("count = 1").select("entry")
        marks = marks.unionByName(marked_by_count(distinct, tuple(finer)).join(once, "entry").withColumnRenamed("entry", "piece"))
    return pieces.select("entry", "at", "piece").join(C.written(marks, "piece-marks"), "piece").groupBy("entry").agg(
        F.flatten(F.collect_list(F.transform("ranges", lambda r: F.array(F.col("at") + r[0], F.col("at") + r[1])))).alias("ranges"))


def text_marks(rows: DataFrame, full: int = FULL) -> DataFrame:
    """(tid, marks) of (tid, text): ranges [from, to) of window starts that are repeated in distinct texts."""
    found = phrases(rows)
    occurrence = F.xxhash64("tid", "start")
    # A trigger string that occurs at two places at least; copies of a text are one place.
    shared = found.groupBy("trigger").agg(F.min(occurrence).alias("a"), F.max(occurrence).alias("b")) \
        .where("a != b").select("trigger")
    shared = C.written(shared, "shared")  # a table of its own, so that Spark can split a hot trigger in the join
    wanted = found.join(shared, "trigger").groupBy("tid") \
        .agg(F.collect_set(F.struct("start", "n", "trigger", "lead")).alias("phrases"))
    texts = rows.groupBy("tid").agg(F.first("text").alias("text"))
    parsed_entries = C.written(entries(texts, wanted), "entries")
    dictionary = C.written(parsed_entries.groupBy("trigger", "entry", "n").agg(
        F.first("raw").alias("raw"), F.first("lead").alias("lead"), F.count("*").alias("count")), "dictionary")
    sizes = dictionary.groupBy("trigger").agg(F.count("*").alias("size"))
    hot = C.written(sizes.where(F.col("size") > full).select("trigger"), "hot")
    marks = marked_in_order(dictionary.join(hot, "trigger", "left_anti"))
    if not hot.isEmpty():
        marks = marks.unionByName(marked_by_count(dictionary.join(hot, "trigger", "left_semi")))
    return parsed_entries.select("tid", "start", "entry").join(marks, "entry").groupBy("tid") \
        .agg(F.flatten(F.collect_list(F.transform("ranges", lambda r: F.struct(
            (F.col("start") + r[0]).alias("a"), (F.col("start") + r[1] - 1 + N).alias("b"))))).alias("marks"))


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans sorted, with those that meet or overlap made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_CUT = pa.schema([("tid", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def cut_texts(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """(tid, n_removed, n_spans, kept_sha256) of the texts with marks."""
    def run(tid, text, spans):
        out = {k: [] for k in _CUT.names}
        for t, x, s in zip(tid.to_pylist(), text, spans):
            data, removed = x.as_py().encode(), union_of([(r["a"], r["b"]) for r in s.as_py()])
            kept, at = hashlib.sha256(), 0
            for a, b in removed:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            for k, v in zip(_CUT.names, (t, sum(b - a for a, b in removed), len(removed), kept.hexdigest())):
                out[k].append(v)
        return out

    return texts.join(marks, "tid").select("tid", "text", "marks").mapInArrow(
        C.by_batch(run, _CUT, "tid", "text", "marks"), "tid bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def named(rows: DataFrame, number: Callable[[str], Column]) -> DataFrame:
    """``rows`` with ``sha``, the SHA-256 of the text, and ``tid``, a number of it: different texts that share a
    number take one of their SHA-256 instead, so that none goes as a copy of another."""
    rows = rows.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256)).withColumn("tid", number("text").cast("bigint"))
    # Only numbers are shuffled; there is no clash up to about 2^32 texts, and then no join.
    second = rows.select("tid", F.xxhash64("sha").alias("other"))
    clashes = C.written(second.groupBy("tid").agg(F.min("other").alias("lo"), F.max("other").alias("hi"))
                        .where("lo != hi").select("tid"), "clashes")
    if clashes.isEmpty():
        return rows
    return rows.join(clashes.withColumn("clash", F.lit(True)), "tid", "left") \
        .withColumn("tid", F.when(F.col("clash"), F.xxhash64("sha")).otherwise(F.col("tid"))).drop("clash")


def remove_repeats(docs: DataFrame, full: int = FULL, number: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row; ``number`` tells texts apart at first."""
    rows = named(C.texts(docs), number)
    long = rows.where(F.octet_length("text") >= N).select("tid", "text")
    # A text that two rows hold goes as a whole, whatever else it shares.
    copied = long.groupBy("tid").agg(F.count("*").alias("rows")).where("rows > 1").select("tid")
    marks = C.written(text_marks(long, full), "marks")
    partly = marks.join(copied, "tid", "left_anti")
    texts = long.join(partly.select("tid"), "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text"))
    cut = cut_texts(texts, partly)
    empty = hashlib.sha256(b"").hexdigest()
    size = F.octet_length("text").cast("bigint")
    flat = rows.select("doc_id", "tid", size.alias("n_bytes"), "sha")
    return flat.join(copied.withColumn("copy", F.lit(True)), "tid", "left").join(cut, "tid", "left").select(
        "doc_id", "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
