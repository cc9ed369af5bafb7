"""How filters interact: truth-table survival words and carry-save positional popcounts.

Each document has a mask of the filters that it fails.  Its survival word has 32
bits, one for each subset of the five filters: bit S is set if the document
passes every filter in S.  The words of a part and label are added up position
by position, in carry-save form: three words become a word of sums and a word of
carries of twice the weight, until two or less of a weight are left.  That
gives the survivors of every subset in one pass, and from these the kept,
removed, redundant, unique and Shapley figures of all 120 orders are
differences: no filter is run in any order.

What a document's text decides (four filters) is computed once where it is
read; texts aren't shuffled, only their 128-bit digests.  Rows that are alike in
id, text and part are one row with a number, and a number's binary digits are the
weights at which its word enters the popcounts; so neither copies of a text nor
repeated rows gather anywhere.

Nulls: a null text is empty, a null part is the empty string; a null id is neither
smaller nor larger than any other.  Repeated rows are counted one by one, and
are no copies of each other (neither id is smaller).  A document with
several rows of labels has a label if one of them is 1.  Very long texts cost their
own length.  Empty table: no parts, no rows.
"""

from __future__ import annotations

import hashlib
from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
MIN_WORDS = 200  # A
DISTINCT_PERCENT = 50  # B
CAPITAL_PERCENT = 2  # C
MARKS = b"#$%&*|"  # D
_DROP = bytes(b for b in range(256) if b not in MARKS)
_NO_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)


def text_mask(text: bytes, points: int) -> int:
    """The bits of A to D that a text of ``points`` code points fails."""
    words = text.split()  # bytes: only white space of ASCII separates
    n = len(words)
    return ((n < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
            | (100 * len(text.translate(None, _NO_CAPITALS)) > CAPITAL_PERCENT * points) << 2
            | bool(text.translate(None, _DROP)) << 3)


def survival_word(mask: int) -> int:
    """Bit S is set if no filter of subset S is in the mask."""
    return sum(1 << s for s in range(SUBSETS) if not s & mask)


WORDS = np.array([survival_word(m) for m in range(SUBSETS)], np.uint32)


def popcounts(words: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """How many of the words have each bit set, by carry-save addition; word i counts ``times[i]`` times."""
    planes = {0: [words]} if times is None else {
        k: [words[(times >> k) & 1 == 1]] for k in range(int(times.max(initial=0)).bit_length())}
    counts = np.zeros(32, np.int64)
    weight = 0
    while weight <= max(planes, default=-1):
        left = np.concatenate(planes.pop(weight, [np.zeros(0, np.uint32)]))
        carries = []
        while len(left) > 2:
            k = len(left) // 3
            a, b, c = left[:k], left[k:2 * k], left[2 * k:3 * k]
            half = a ^ b
            carries.append((a & b) | (half & c))
            left = np.concatenate([half ^ c, left[3 * k:]])
        for word in left.tolist():
            counts += ((word >> np.arange(32)) & 1) << weight
        if carries:
            planes.setdefault(weight + 1, []).extend(carries)
        weight += 1
    return counts


_MASKED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])


def masked(docs: DataFrame, part_col: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask) of each row; the mask has the filters that the text alone decides."""
    def run(doc_id, part, text):
        data, at = C.flat(text)
        raw, points = data.tobytes(), ((data & 0xC0) != 0x80).astype(np.int8)  # a code point starts at all but these
        starts = np.concatenate([[0], np.cumsum(points, dtype=np.int64)])[at]
        rows = [(raw[a:b], n) for a, b, n in zip(at[:-1].tolist(), at[1:].tolist(), np.diff(starts).tolist())]
        return {"doc_id": doc_id, "part": part, "digest": [hashlib.blake2b(t, digest_size=16).digest() for t, _ in rows],
                "mask": [text_mask(t, n) for t, n in rows]}

    return docs.select("doc_id", F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        C.by_batch(run, _MASKED, "doc_id", "part", "text"), "doc_id bigint, part string, digest binary, mask int")


_COUNTED = pa.schema([("part", pa.string()), ("subset", pa.int32()), *((c, pa.int64()) for c in ("n", "good", "toxic"))])
_COUNTED_DDL = "part string, subset int, n bigint, good bigint, toxic bigint"


def survivors(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """(part, subset, n, good, toxic): documents of a part that pass every filter of a subset, all and by label."""
    rows = C.written(masked(docs, part_col).groupBy("doc_id", "part", "digest", "mask")
                     .agg(F.count(F.lit(1)).alias("rows")), "masks")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null") \
        .withColumn("first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(*(F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")))
    copy = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 1 << FILTERS.index("E")).otherwise(0)
    flag = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    judged = rows.join(firsts, ["doc_id", "digest"], "left").join(marks, "doc_id", "left").select(
        "part", F.col("mask").bitwiseOR(copy).alias("mask"), "rows",
        (flag("quality") + 2 * flag("toxic")).alias("label"))

    def count(part, mask, times, label):
        words, times, label = WORDS[mask.to_numpy()], times.to_numpy(), label.to_numpy()
        codes = part.dictionary_encode()
        names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy()
        out = {k: [] for k in _COUNTED.names}
        order = np.argsort(code, kind="stable")
        ends = np.searchsorted(code[order], np.arange(len(names) + 1))
        for name, a, b in zip(names, ends[:-1].tolist(), ends[1:].tolist()):
            own = order[a:b]
            sums = [popcounts(words[x], times[x]) for k in range(4) for x in [own[label[own] == k]]]
            out["part"] += [name] * SUBSETS
            out["subset"] += range(SUBSETS)
            for c, labelled in (("n", sums), ("good", sums[1::2]), ("toxic", sums[2:])):
                out[c] += sum(labelled).tolist()
        return out

    return judged.mapInArrow(C.by_batch(count, _COUNTED, "part", "mask", "rows", "label"), _COUNTED_DDL) \
        .groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def shapley(alive: Column, f: int) -> Column:
    """What filter ``f`` removes, summed over all orders; ``alive`` holds the survivors by subset."""
    n, others = len(FILTERS), [g for g in range(len(FILTERS)) if g != f]
    total = F.lit(0).cast("bigint")
    for size in range(n):
        for before in combinations(others, size):
            s = sum(1 << g for g in before)
            total = total + factorial(size) * factorial(n - 1 - size) * (alive[s] - alive[s | 1 << f])
    return total


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    parts = survivors(docs, labels, part_col).groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("s"))  # 32 a part
    alive = lambda c: F.transform("s", lambda x: x[c])
    parts = parts.select("part", *(alive(c).alias(c) for c in ("n", "good", "toxic")))
    parts = parts.select("*", F.array(*(shapley(F.col("n"), f) for f in range(len(FILTERS)))).alias("_shapley"))
    orders = F.split(F.lit(" ".join("".join(p) for p in permutations(FILTERS))), " ")
    bits = lambda c: sum((F.contains(c, F.lit(f)).cast("int") * (1 << k) for k, f in enumerate(FILTERS)), F.lit(0))
    rows = parts.select("*", F.explode(orders).alias("filter_order")) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")) \
        .withColumn("_before", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))) \
        .withColumn("_own", bits(F.substring("filter_order", F.col("step"), F.lit(1)))) \
        .withColumn("_after", F.col("_before") + F.col("_own"))
    lost = lambda c: F.get(c, F.col("_before")) - F.get(c, F.col("_after"))
    every = SUBSETS - 1
    failing = F.get("n", F.lit(0)) - F.get("n", F.col("_own"))
    return rows.select(
        "part", "filter_order", "step", F.get("n", F.col("_after")).alias("kept"), lost("n").alias("removed"),
        (failing - lost("n")).alias("redundant"),
        (F.get("n", every - F.col("_own")) - F.get("n", F.lit(every))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("_shapley", F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1)
        .alias("shapley"))
