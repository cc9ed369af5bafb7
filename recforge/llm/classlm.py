"""Scores of texts under a class-based bigram model (Brown), learned from the corpus.

P(word | word before) = P(class | class before) * P(word | class).

Classes.  Words with at least ``SHARE`` of all training tokens, of which there
can't be more than 1 / SHARE, are assigned to ``CLASSES`` classes by exchange: the
class-pair counts of all training tokens say for each word which class would
raise the likelihood of the training text the most, and words move there, a
share of them at a time, until all have had a turn and the likelihood has not
risen any more.  Every other word met at least ``LEAST`` times is then put into
the class that makes it and its neighbours the most likely, by the classes of
the neighbours of all its training occurrences.  Words met less often are one class, which
words not met in training share.  The end of a text is a class of its own, and
the one before its first word.

Statistics.  Counts of words, of classes and of class pairs are taken over all
training tokens.  What grows with the vocabulary is only ever joined: texts are packed
into blocks of word numbers, each with the list of its distinct words, and a
block gets the counts of its own words alone.  What tasks or the driver hold
whole has at most 1 / SHARE rows or one for each pair of classes; a word that isn't
exchanged is one row of two bytes an occurrence, of which it has less than SHARE of all.

A document is held out if the CRC-32 of its id as text is 2 modulo 7.

Nulls: a null text has no words but an end; a null id is in training.  Repeated
rows count once each.  Empty table: no rows.
"""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C

SHARE = 1 / 5000  # of all tokens: words from there on are exchanged
CLASSES = 64
LEAST = 2  # occurrences of a word with a class of its neighbours' choice; fewer stand for words not met
TURNS = 4  # a word may move in one of so many rounds, a cycle
ENOUGH = 0.0  # share of the likelihood that a cycle must gain for another to follow
BLOCK = 1 << 23  # bytes of text in a block
ALPHA, DELTA = 0.1, 1.0  # added to the counts of classes and of words
PRIOR = 100.0  # weight, in tokens, of what follows any class beside what follows this one
REST = CLASSES
END = CLASSES + 1
ALL = END + 1


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def pack(x: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed byte by byte of their places."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack(b: bytes) -> np.ndarray:
    import zstandard
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


_BLOCKS = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                     ("lengths", pa.list_(pa.int32())), ("ids", pa.binary()), ("words", pa.list_(pa.string())),
                     ("train", pa.list_(pa.int64()))])
_BLOCKS_DDL = ("block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, ids binary, "
               "words array<string>, train array<bigint>")


def blocks(docs: DataFrame) -> DataFrame:
    """The corpus as blocks: documents, their numbers of words, the words as numbers in the block's
    list of distinct words, and the training count of each of these."""
    def finish(ids, held, lengths, parts, index):
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        train = np.bincount(flat[np.repeat(~np.array(held, bool), lengths)], minlength=len(index))
        return pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip(
                (random.SystemRandom().getrandbits(63), ids, held, lengths, pack(flat),
                 [w.decode() for w in index], train), _BLOCKS)], schema=_BLOCKS)

    def run(batches):
        size, ids, held, lengths, parts, index = 0, [], [], [], [], {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().encode().lower().split()
                parts.append(np.array([index.setdefault(w, len(index)) for w in words], np.uint32))
                ids.append(doc_id)
                held.append(held_out(doc_id))
                lengths.append(len(words))
                size += len(text.as_buffer()) + 16
                if size >= BLOCK:
                    yield finish(ids, held, lengths, parts, index)
                    size, ids, held, lengths, parts, index = 0, [], [], [], [], {}
        if ids:
            yield finish(ids, held, lengths, parts, index)

    return C.texts(docs).mapInArrow(run, _BLOCKS_DDL)


def training_counts(packed: DataFrame) -> DataFrame:
    """(word, c) over the training tokens of all blocks."""
    return packed.select(F.explode(F.arrays_zip("words", "train")).alias("x")).where("x.train > 0") \
        .groupBy(F.col("x.words").alias("word")).agg(F.sum("x.train").alias("c"))


def sums_by_pair(batches, size: int):
    """Partial sums of square count matrices, as rows (a, b, n)."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for code in batches:
        new, n = np.unique(code, return_counts=True)
        both = np.concatenate([codes, new])
        codes, at = np.unique(both, return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, n]), len(codes)).astype(np.int64)
    if len(codes):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (codes // size, codes % size, counts)], ["a", "b", "n"])


def pairs_of(tokens: np.ndarray, lengths: np.ndarray, end: int, size: int) -> np.ndarray:
    """Codes before * size + after of neighbours in each text, with ``end`` before it and after it."""
    padded = np.full(len(tokens) + len(lengths), end, np.int64)
    mask = np.ones(len(padded), bool)
    mask[np.cumsum(np.asarray(lengths) + 1) - 1] = False
    padded[mask] = tokens
    return np.concatenate([[end], padded[:-1]]) * size + padded


def frequent_pairs(packed: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(a, b, n) of neighbouring frequent words in training texts; all other words are one, and the end another."""
    rest, end, size = len(frequent), len(frequent) + 1, len(frequent) + 2
    names = pa.array(list(frequent), pa.string())

    def run(batches):
        def codes():
            for batch in batches:
                for ids, words, lengths, held in zip(*batch.columns):
                    number = pc.fill_null(pc.index_in(words.values, value_set=names), rest).to_numpy(zero_copy_only=False)
                    lengths, held = lengths.values.to_numpy().astype(np.int64), held.values.to_numpy(zero_copy_only=False)
                    tokens = number[unpack(ids.as_py())]
                    yield pairs_of(tokens[np.repeat(~held, lengths)], lengths[~held], end, size)
        return sums_by_pair(codes(), size)

    return packed.select("ids", "words", "lengths", "held").mapInArrow(run, "a bigint, b bigint, n bigint") \
        .groupBy("a", "b").agg(F.sum("n").alias("n"))


def xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def likelihood(n: np.ndarray) -> float:
    """What of the log-likelihood of training depends on the classes."""
    return float(xlogx(n).sum() - xlogx(n.sum(1)).sum() - xlogx(n.sum(0)).sum())


def best_move(n: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, itself: int, classes: int) -> tuple[int, float]:
    """Where a word of class ``own`` raises the likelihood most, and by how much.

    n: class-pair counts; left, right: counts of the classes before and after
    the word's occurrences, without the word itself; itself: pairs of it alone.
    """
    without = n.astype(np.float64)
    without[:, own] -= left
    without[own, :] -= right
    without[own, own] -= itself
    rows, columns = without.sum(1), without.sum(0)
    now = likelihood(n)
    # Putting the word into class k changes row k, column k and their crossing, and all sums they meet.
    row_add, column_add = right.sum() + itself, left.sum() + itself
    gain_column = xlogx(without[:, :classes] + left[:, None]).sum(0) - xlogx(without[:, :classes]).sum(0)
    gain_row = xlogx(without[:classes] + right[None]).sum(1) - xlogx(without[:classes]).sum(1)
    cross = np.diag(without)[:classes]
    l, r = left[:classes], right[:classes]
    fix = xlogx(cross + l + r + itself) - xlogx(cross + l) - xlogx(cross + r) + xlogx(cross)
    sum_rows = xlogx(rows + left).sum() - xlogx(rows + left)[:classes] + xlogx(rows[:classes] + l + row_add)
    sum_columns = xlogx(columns + right).sum() - xlogx(columns + right)[:classes] + xlogx(columns[:classes] + r + column_add)
    value = xlogx(without).sum() + gain_column + gain_row + fix - sum_rows - sum_columns
    k = int(np.argmax(value))
    return k, float(value[k] - now)


def neighbours(pairs: DataFrame) -> DataFrame:
    """(word, near): for each word what stands after it (side 1) and before it (side 0), and how often; at most
    twice as many as there are words.  A word beside itself is on side 1 alone."""
    after = pairs.select(F.col("a").alias("word"), F.struct(F.col("b").alias("other"), F.lit(1).alias("side"), "n").alias("x"))
    before = pairs.where("a != b").select(F.col("b").alias("word"), F.struct(F.col("a").alias("other"), F.lit(0).alias("side"), "n").alias("x"))
    return after.unionAll(before).groupBy("word").agg(F.collect_list("x").alias("near"))


def entries(word: pa.Array, near: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, word, neighbour, side and count of all entries of a batch of ``neighbours``."""
    flat, at = near.flatten(), np.repeat(np.arange(len(near)), near.value_lengths().to_numpy(zero_copy_only=False))
    other, side, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    return at, word.to_numpy(zero_copy_only=False)[at], other, side, n


def class_pairs(near: DataFrame, tries: list[np.ndarray], size: int) -> np.ndarray:
    """Class-pair counts under each of some assignments, in one pass: a matrix a task and assignment reaches the driver."""
    def run(batches):
        total = np.zeros((len(tries), size * size), np.int64)
        for batch in batches:
            _, word, other, side, n = entries(*batch.columns)
            word, other, n = (x[side == 1] for x in (word, other, n))
            for mine, of in zip(total, tries):
                np.add.at(mine, of[word] * size + of[other], n)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["n"])

    parts = near.select("word", "near").mapInArrow(run, "n binary").collect()
    out = np.zeros((len(tries), size, size))
    for r in parts:
        out += np.frombuffer(r["n"], np.int64).reshape(out.shape)
    return out


def exchange(pairs: DataFrame, n_words: int, classes: int = CLASSES, rounds: int | None = None, turns: int = TURNS,
             enough: float = ENOUGH) -> np.ndarray:
    """Classes of the words 0..n_words-1, given their pair counts; word n_words and n_words + 1 keep
    classes of their own.

    Words' neighbours are gathered once.  A round is two passes over them without an exchange: moves come
    back as a row a word, then the class-pair counts after them.  Words of one turn move
    together; if that lowers the likelihood, the better half of them moves, or its better half, and so on.
    ``rounds``, if given, is the most that run.
    """
    of = np.concatenate([np.arange(n_words) % classes, [classes, classes + 1]]).astype(np.int64)
    size = classes + 2
    if not n_words:
        return of
    schema = pa.schema([("word", pa.int64()), ("to", pa.int64()), ("gain", pa.float64())])
    near = C.written(neighbours(pairs), "near")
    n = class_pairs(near, [of], size)[0]
    before_cycle = likelihood(n)
    for turn in itertools.count() if rounds is None else range(rounds):
        def move(word, lists, of=of, n=n):
            at, own, other, side, count = entries(word, lists)
            itself = np.bincount(at, count * (other == own), len(word))
            apart = other != own
            sides = np.bincount(((at * 2 + side) * size + of[other])[apart], count[apart], len(word) * 2 * size).reshape(-1, 2, size)
            best = [best_move(n, int(of[w]), beside[0], beside[1], i, classes) for w, beside, i in zip(word.to_pylist(), sides, itself)]
            return {"word": word, "to": [k for k, _ in best], "gain": [g for _, g in best]}

        moving = near.where((F.col("word") < n_words) & (F.col("word") % turns == turn % turns))
        moves = moving.mapInArrow(C.by_batch(move, schema, "word", "near"), "word bigint, to bigint, gain double") \
            .where("gain > 0").collect()  # at most 1 / SHARE rows
        moves.sort(key=lambda m: (-m.gain, m.word))
        tries = []
        while moves:
            tries.append(of.copy())
            for m in moves:
                tries[-1][m.word] = m.to
            moves = moves[:len(moves) // 2]
        for tried, after_n in zip(tries, class_pairs(near, tries, size) if tries else ()):
            if likelihood(after_n) > likelihood(n):
                of, n = tried, after_n
                break
        if turn % turns == turns - 1:
            now = likelihood(n)
            if now - before_cycle <= enough * abs(now):
                break
            before_cycle = now
    return of


def by_neighbours(n: np.ndarray, left: np.ndarray, right: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """For each word the class under which its occurrences are the most likely.

    n: class-pair counts; left, right: a row a word, how often its neighbours before and after it are of each class.
    A class k gives sum log P(k | class before) + sum log P(class after | k) + count * log(count / (all of k, with the word)).
    """
    logs = np.log(following(n))
    count = left.sum(1, keepdims=True)
    value = left @ logs[:, :classes] + right @ logs[:classes].T - count * np.log(n.sum(0)[:classes] + count)
    return value.argmax(1)


def other_words(packed: DataFrame, frequent: dict[str, int], of: np.ndarray, n: np.ndarray) -> DataFrame:
    """(word, c, class) of the training words that weren't exchanged, by the classes of their neighbours in training."""
    names, size = pa.array(list(frequent), pa.string()), ALL

    def occurrences(batches):
        for batch in batches:
            for ids, words, lengths, held in zip(*batch.columns):
                number = pc.fill_null(pc.index_in(words.values, value_set=names), len(frequent)).to_numpy(zero_copy_only=False)
                lengths, held = lengths.values.to_numpy().astype(np.int64), held.values.to_numpy(zero_copy_only=False)
                ids = unpack(ids.as_py())[np.repeat(~held, lengths)]
                beside = pairs_of(of[number[ids]], lengths[~held], END, size)  # a code a token, and one an end
                ends = np.cumsum(lengths[~held] + 1) - 1
                inner = np.ones(len(beside), bool)
                inner[ends] = False
                at = np.flatnonzero(inner)
                near = np.stack([beside[at] // size, beside[at + 1] % size], 1).astype(np.uint8)
                rest = np.flatnonzero(number[ids] == len(frequent))
                rest = rest[np.argsort(ids[rest], kind="stable")]
                which, counts = np.unique(ids[rest], return_counts=True)
                edge = np.concatenate([[0], np.cumsum(2 * counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [words.values.take(pa.array(which)),
                     pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(edge), pa.py_buffer(near[rest].tobytes())])],
                    ["word", "near"])

    schema = pa.schema([("word", pa.string()), ("c", pa.int64()), ("class", pa.int32())])

    def choose(word, near):
        sizes = np.array([sum(map(len, x)) // 2 for x in near.to_pylist()], np.int64)
        sides = np.frombuffer(b"".join(b for x in near.to_pylist() for b in x), np.uint8).reshape(-1, 2).astype(np.int64)
        row = np.repeat(np.arange(len(word)), sizes) * size
        left, right = (np.bincount(row + sides[:, i], minlength=len(word) * size).reshape(-1, size).astype(float) for i in (0, 1))
        return {"word": word, "c": sizes, "class": np.where(sizes >= LEAST, by_neighbours(n, left, right), REST).astype(np.int32)}

    return packed.select("ids", "words", "lengths", "held").mapInArrow(occurrences, "word string, near binary") \
        .groupBy("word").agg(F.collect_list("near").alias("near")) \
        .mapInArrow(C.by_batch(choose, schema, "word", "near"), "word string, c bigint, class int")


_CODED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base_score", pa.float64()), ("emission", pa.float64()), ("classes", pa.binary())])
_CODED_DDL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, emission double, "
              "classes binary")


def coded(packed: DataFrame, counts: DataFrame, tokens: int, words: int, ends: int, totals: np.ndarray, kinds: np.ndarray) -> DataFrame:
    """A row for each document: its base score, its words' part of the score and its classes.

    counts: (word, c, class); totals, kinds: training tokens and words of each class.
    """
    known = packed.select("block", F.posexplode("words").alias("at", "word")).join(counts, "word") \
        .select(F.col("block").alias("of_block"), "at", "c", "class")
    rows = packed.select("block", "doc_ids", "held", "lengths", "ids", F.size("words").alias("n_words"))

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        doc_ids, held, lengths, ids, n_words = (block[c][0] for c in ("doc_ids", "held", "lengths", "ids", "n_words"))
        lengths = lengths.values.to_numpy().astype(np.int64)
        c, k = np.zeros(n_words.as_py(), np.int64), np.full(n_words.as_py(), CLASSES, np.int64)
        at = found["at"].to_numpy()
        c[at], k[at] = found["c"].to_numpy(), found["class"].to_numpy()
        base = np.log10((c + 1) / (tokens + words + 1))
        emission = np.log10((c + DELTA) / (totals[k] + DELTA * (kinds[k] + 1)))
        ids, edge = unpack(ids.as_py()), np.concatenate([[0], np.cumsum(lengths)])
        total = lambda x: np.array([x[ids[a:b]].sum() for a, b in zip(edge, edge[1:])])
        classes = k.astype(np.uint8)
        return pa.Table.from_arrays([
            doc_ids.values, held.values, pa.array(lengths + 1),
            pa.array((total((c > 0).astype(np.int64)) + (ends > 0)).astype(np.int64)),
            pa.array(total(base) + np.log10((ends + 1) / (tokens + words + 1))), pa.array(total(emission).astype(np.float64)),
            pa.array([classes[ids[a:b]].tobytes() for a, b in zip(edge, edge[1:])], pa.binary())], schema=_CODED)

    # A block and the counts of its words: both bounded by the block's bytes.
    return rows.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(run, _CODED_DDL)


def class_sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = [x or b"" for x in column.to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8).astype(np.int64), np.array([len(x) for x in raw], np.int64)


def transitions(documents: DataFrame) -> np.ndarray:
    """Class-pair counts of the training documents: a row for each pair of classes reaches the driver."""
    def run(batches):
        return sums_by_pair((pairs_of(*class_sequence(b.column(0)), END, ALL) for b in batches), ALL)

    n = np.zeros((ALL, ALL))
    for r in documents.where("not held_out").select("classes").mapInArrow(run, "a bigint, b bigint, n bigint") \
            .groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        n[r.a, r.b] = r.n
    return n


def following(n: np.ndarray) -> np.ndarray:
    """P(class | class before) from class-pair counts, smoothed by what follows any class."""
    any_class = (n.sum(0) + ALPHA) / (n.sum() + ALPHA * len(n))
    return (n + PRIOR * any_class) / (n.sum(1, keepdims=True) + PRIOR)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) for each row."""
    packed = C.written(blocks(docs), "blocks")
    counts = C.written(training_counts(packed), "counts")
    held = F.aggregate("held", F.lit(0), lambda s, h: s + F.when(h, 0).otherwise(1))
    ends = int(packed.agg(F.sum(held)).first()[0] or 0)
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    tokens, words = int(n or 0) + ends, int(v) + (ends > 0)
    # At most 1 / SHARE words can have SHARE of the tokens.
    top = sorted(counts.where(F.col("c") >= SHARE * tokens).collect(), key=lambda r: (-r.c, r.word)) if tokens else []
    frequent = {r.word: i for i, r in enumerate(top)}
    pairs = C.written(frequent_pairs(packed, frequent), "pairs")
    of = exchange(pairs, len(frequent))
    exchanged = docs.sparkSession.createDataFrame([(r.word, r.c, int(of[frequent[r.word]])) for r in top], "word string, c bigint, class int")
    n = class_pairs(neighbours(pairs), [of], ALL)[0]
    classed = C.written(other_words(packed, frequent, of, n).unionByName(exchanged), "classed")
    totals, kinds = np.zeros(ALL), np.zeros(ALL)
    for r in classed.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        totals[r["class"]], kinds[r["class"]] = r.c, r.n
    documents = C.written(coded(packed, classed, tokens, words, ends, totals, kinds), "coded")
    logs = np.log10(following(transitions(documents))).ravel()
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())])

    def run(doc_id, held_out, n_tokens, n_known, base_score, emission, classes):
        sequence, lengths = class_sequence(classes)
        steps = logs[pairs_of(sequence, lengths, END, ALL)]
        ends = np.cumsum(lengths + 1)
        total = np.array([steps[b - m:b].sum() for b, m in zip(ends, lengths + 1)]) + emission.to_numpy()
        return {"doc_id": doc_id, "held_out": held_out, "n_tokens": n_tokens, "n_known": n_known,
                "train_tokens": [tokens] * len(lengths), "base_score": base_score, "score": total,
                "perplexity": 10 ** (-total / (lengths + 1))}

    return documents.mapInArrow(
        C.by_batch(run, schema, "doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "classes"),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
        "score double, perplexity double")
