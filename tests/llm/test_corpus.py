"""Operators that look at the whole corpus, against brute force."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from recforge.llm import classlm, decontam, grams, queries, repeats, simhash
from recforge.llm.components import components

from .conftest import SHARED, TEXTS, frame, rows_of

SMALL = "/root/testdata/sf0.001"


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


# Class-based bigrams

def pair_matrix(pairs, of, size):
    n = np.zeros((size, size))
    for (a, b), c in np.ndenumerate(pairs):
        n[of[a], of[b]] += c
    return n


def test_best_move_is_the_best():
    rng = np.random.default_rng(0)
    words, classes = 10, 4
    pairs = rng.integers(0, 9, (words + 2, words + 2)).astype(float)
    of = np.concatenate([rng.integers(0, classes, words), [classes, classes + 1]])
    n = pair_matrix(pairs, of, classes + 2)
    for w in range(words):
        left, right = np.zeros(classes + 2), np.zeros(classes + 2)
        for x in range(words + 2):
            if x != w:
                left[of[x]] += pairs[x, w]
                right[of[x]] += pairs[w, x]
        k, gain = classlm.best_move(n, int(of[w]), left, right, pairs[w, w], classes)
        gains = []
        for c in range(classes):
            moved = of.copy()
            moved[w] = c
            gains.append(classlm.likelihood(pair_matrix(pairs, moved, classes + 2)) - classlm.likelihood(n))
        assert gain == pytest.approx(max(gains)) == pytest.approx(gains[k])


def test_exchange_finds_planted_classes(spark):
    """Words of two kinds that always alternate end up in classes of one kind."""
    rng = random.Random(3)
    pairs = collections.Counter((rng.randrange(0, 6), rng.randrange(6, 12)) for _ in range(4000))
    pairs.update((rng.randrange(6, 12), rng.randrange(0, 6)) for _ in range(4000))
    table = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a bigint, b bigint, n bigint")
    of = classlm.exchange(table, 12, classes=2, rounds=12, turns=4)
    assert len(set(of[:6])) == 1 and len(set(of[6:12])) == 1 and of[0] != of[6]


def test_exchange_ends_where_a_cycle_gains_little(spark):
    """Without a number of rounds, no cycle that begins at the result gains the stated share."""
    rng = random.Random(8)
    pairs = collections.Counter((min(int(rng.expovariate(.15)), 23), (w := rng.randrange(24))) for _ in range(5000))
    pairs.update((w, (w * 5 + rng.randrange(3)) % 24) for w in range(24) for _ in range(60))
    table = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a bigint, b bigint, n bigint")
    of = classlm.exchange(table, 24, classes=4, enough=1e-3)
    dense = np.zeros((26, 26))
    for (a, b), n in pairs.items():
        dense[a, b] = n
    start = np.concatenate([np.arange(24) % 4, [4, 5]])
    reached = classlm.likelihood(pair_matrix(dense, of, 6))
    assert reached > classlm.likelihood(pair_matrix(dense, start, 6))
    further = classlm.exchange(table, 24, classes=4, rounds=40, enough=0)
    assert classlm.likelihood(pair_matrix(dense, further, 6)) >= reached


def test_exchange_ends_at_an_optimum(spark):
    """No word's move raises the likelihood any more."""
    rng = random.Random(5)
    dense = np.zeros((22, 22))
    for _ in range(6000):
        a = min(int(rng.expovariate(.2)), 19)
        dense[a, (a * 3 + rng.randrange(4)) % 20] += 1
    table = spark.createDataFrame([(a, b, int(n)) for (a, b), n in np.ndenumerate(dense) if n], "a bigint, b bigint, n bigint")
    of = classlm.exchange(table, 20, classes=5)
    n = pair_matrix(dense, of, 7)
    for w in range(20):
        left, right = (np.bincount(of, x * (np.arange(22) != w), 7) for x in (dense[:, w], dense[w]))
        assert classlm.best_move(n, int(of[w]), left, right, dense[w, w], 5)[1] < 1e-6


def test_words_that_are_not_exchanged_take_their_neighbours_choice(spark):
    """Two kinds of frequent words alternate; rare words stand in the place of one kind; words met once have the class of unknown ones."""
    rng = random.Random(6)
    ids = [i for i in range(60) if not classlm.held_out(i)][:20]
    texts = []
    for i in ids:
        words = [f"{'ab'[j % 2]}{rng.randrange(6)}" for j in range(600)]
        words[100], words[201], words[301] = f"likea{i // 2}", f"likeb{i // 2}", f"once{i}"
        words[300], words[401] = f"likea{i // 2}", f"likeb{i // 2}"
        texts.append((i, " ".join(words)))
    packed = classlm.blocks(frame(spark, texts)).checkpoint()
    frequent = {f"{k}{i}": j * 6 + i for j, k in enumerate("ab") for i in range(6)}
    of = np.array([0] * 6 + [1] * 6 + [classlm.REST, classlm.END])
    n = classlm.class_pairs(classlm.neighbours(classlm.frequent_pairs(packed, frequent)), [of], classlm.ALL)[0]
    got = {r.word: (r.c, r["class"]) for r in classlm.other_words(packed, frequent, of, n).collect()}
    counts = collections.Counter(w for _, t in texts for w in t.split() if w not in frequent)
    assert got == {w: (c, classlm.REST if c < classlm.LEAST else int(w.startswith("likeb"))) for w, c in counts.items()}


def plain_base(texts):
    words = [(i, (t or "").encode().lower().split() + [None]) for i, t in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    counts = collections.Counter(w for (_, ws), h in zip(words, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
            for (i, ws), h in zip(words, held)]


@pytest.mark.parametrize("which", ["messy", "documents"])
def test_language_model(spark, messy, which):
    texts = TEXTS if which == "messy" else documents(spark)
    got = classlm.score(messy).collect() if which == "messy" else queries.op6_class_lm(spark, SMALL).collect()
    exact = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got), key=repr)
    plain = plain_base(texts)
    assert exact == sorted((p[:5] for p in plain), key=repr)
    assert sorted(r.base_score for r in got) == pytest.approx(sorted(p[5] for p in plain))
    assert all(r.score < 0 and math.isfinite(r.score) and r.perplexity >= 1 for r in got)
    if which == "documents":  # the model says more of held-out texts than counts of words alone
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_transitions_are_distributions():
    n = np.random.default_rng(1).integers(0, 50, (classlm.ALL, classlm.ALL)).astype(float)
    n[3] = 0
    assert np.allclose(classlm.following(n).sum(1), 1) and (classlm.following(n) > 0).all()


def test_language_model_without_training(spark, empty):
    assert classlm.score(empty).collect() == []
    held = [i for i in range(200) if classlm.held_out(i)][:3]
    got = classlm.score(frame(spark, [(i, "a b c") for i in held])).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in got) and len(got) == 3


def test_packing():
    x = np.random.default_rng(2).integers(0, 2**32, 1000).astype(np.uint32)
    assert (classlm.unpack(classlm.pack(x)) == x).all() and len(classlm.unpack(classlm.pack(x[:0]))) == 0


# Repeated byte strings

def plain_repeats(texts, n=200):
    raw = [(i, (t or "").encode()) for i, t in texts]
    seen = collections.Counter(d[k:k + n] for _, d in raw for k in range(len(d) - n + 1))
    out = []
    for i, d in raw:
        covered = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - n + 1):
            if seen[d[k:k + n]] > 1:
                covered[k:k + n] = True
        spans = int((covered[1:] & ~covered[:-1]).sum() + covered[:1].sum())
        kept = np.frombuffer(d, np.uint8)[~covered[:-1]].tobytes()
        out.append((i, len(d), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("full", [0, 64])
def test_repeats_on_messy(messy, full):
    assert rows_of(repeats.remove_repeats(messy, full), *COLUMNS) == plain_repeats(TEXTS)


@pytest.mark.parametrize("full", [1, 64])
def test_repeats_random(spark, full):
    rng = random.Random(11)
    letters = lambda n, a="abcd é": "".join(rng.choice(a) for _ in range(n))
    shared = [letters(rng.randrange(150, 420)) for _ in range(6)]
    texts = [(k, "".join(rng.choice([letters(rng.randrange(0, 250)), rng.choice(shared), rng.choice(shared)[rng.randrange(60):]])
                         for _ in range(rng.randrange(0, 6)))) for k in range(60)]
    texts += [(100, "ab" * 300), (101, "a" * 199), (102, "a" * 200), (103, "a" * 201), (104, "xyz" * 67), (105, "\u0000" * 250),
              (106, shared[0]), (107, shared[0])]
    assert rows_of(repeats.remove_repeats(frame(spark, texts), full), *COLUMNS) == plain_repeats(texts)


def test_texts_of_one_number_stay_apart(spark):
    """Different texts that share their first number aren't taken for copies of each other."""
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abc d") for _ in range(n))
    one, other, third = letters(500), letters(500), letters(500)
    texts = [(1, one), (2, other), (3, one), (4, third[:250] + other[:250]), (5, third), (6, "x"), (7, "x"), (8, "y"), (9, None)]
    from pyspark.sql import functions as F
    for number in (F.octet_length, lambda text: F.lit(7)):
        assert rows_of(repeats.remove_repeats(frame(spark, texts), number=number), *COLUMNS) == plain_repeats(texts)


def test_long_texts_are_parsed_in_slices(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(97, 101, 30_000).astype(np.uint8)
    whole = [(r, s.tolist(), n.tolist(), t.tolist()) for r, s, n, t, _ in repeats.parsed(data, np.array([0, len(data)]))]
    monkeypatch.setattr(repeats, "_CHUNK", 4096)
    slices = list(repeats.parsed(data, np.array([0, len(data)])))
    starts = lambda found: sorted(x for _, s, n, *_ in found for a, k in zip(s, n) for x in range(a, a + k))
    assert starts(slices) == starts(whole) == list(range(len(data) - repeats.N + 1))


def test_repeats_on_documents(spark, empty):
    assert rows_of(queries.op8_repeats(spark, SMALL), *COLUMNS) == plain_repeats(documents(spark))
    assert repeats.remove_repeats(empty).collect() == []


# SimHash

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids, radius=2):
    names = sorted(set(fps))
    parent = {f: f for f in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = {}
    for f, i in zip(fps, ids):
        r = root(f)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [least[root(f)] for f in fps]


@pytest.mark.parametrize("which", ["messy", "documents"])
def test_simhash(spark, messy, which):
    texts = TEXTS if which == "messy" else documents(spark)
    fps = [plain_fingerprint(t) for _, t in texts]
    expected = sorted(((i, f, c) for (i, _), f, c in zip(texts, fps, plain_components(fps, [i for i, _ in texts]))), key=repr)
    df = simhash.near_duplicates(messy) if which == "messy" else simhash.near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in df.collect()), key=repr) == expected
    if which == "documents":
        got = rows_of(queries.op9_simhash(spark, SMALL), "doc_id", "fingerprint", "component_id")
        assert got == sorted(((i, f"{f:016x}", c) for i, f, c in expected), key=repr)


def planted_fingerprints():
    rng = random.Random(9)
    fps = set()
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(14):
            x = f
            for _ in range(rng.randrange(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    return sorted(fps)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_bit_sliced_distances(radius):
    fps = np.array(planted_fingerprints(), np.uint64)
    got = {(int(a), int(b)) for q, m in simhash.near(fps, simhash.planes(fps), radius) for a, b in zip(q, m) if b < len(fps)}
    assert got == {(i, j) for i, a in enumerate(fps.tolist()) for j, b in enumerate(fps.tolist()) if (a ^ b).bit_count() <= radius}


@pytest.mark.parametrize("full", [2, 8, 1024])
def test_split_buckets_lose_no_link(spark, full):
    fps = planted_fingerprints()
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    table = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")
    got = {r.fp: r.component_id for r in simhash.grouped(table, 2, full).collect()}
    assert [got[f] for f in signed] == plain_components(fps, range(len(fps)))


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (5, 4), (4, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_one_of_each_group_stays(spark, messy, empty):
    kept = simhash.keep_one(messy)
    assert kept.schema.names == messy.schema.names
    fps = [plain_fingerprint(t) for _, t in TEXTS]
    names = plain_components(fps, [i for i, _ in TEXTS])  # two groups may have one name, as rows share an id
    groups = set(zip(plain_components(fps, range(len(fps))), names))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((n for _, n in groups), key=repr)
    assert simhash.keep_one(empty).collect() == [] and simhash.near_duplicates(empty).collect() == []


# Decontamination

def plain_tiles(doc, item, k):
    """Greedy string tiling by its definition."""
    mark, item_mark, tiles = set(), set(), []
    while True:
        best = None
        for t in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while (p + n < len(doc) and t + n < len(item) and doc[p + n] == item[t + n]
                       and p + n not in mark and t + n not in item_mark):
                    n += 1
                if n >= k and (best is None or n > best[2]):
                    best = (p, t, n)
        if best is None:
            return tiles
        tiles.append(best)
        mark.update(range(best[0], best[0] + best[2]))
        item_mark.update(range(best[1], best[1] + best[2]))


def test_tiles_are_greedy():
    rng = random.Random(12)
    for _ in range(120):
        doc = [rng.choice("abc") for _ in range(rng.randrange(0, 40))]
        item = [rng.choice("abc") for _ in range(rng.randrange(0, 25))]
        seeds = [(p, t) for p in range(len(doc) - 2) for t in range(len(item) - 2) if doc[p:p + 3] == item[t:t + 3]]
        if seeds:
            got = decontam.tile(np.array([s[0] for s in seeds]), np.array([s[1] for s in seeds]), 3)
            assert [n for *_, n in got] == [n for *_, n in plain_tiles(doc, item, 3)]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_leaks(spark, empty):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    w = item.split()
    reordered = " ".join([*w[12:], "and then", *w[6:12], "x", *w[:6]])
    texts = [(1, "intro " + item + " end"), (2, "intro " + reordered), (3, " ".join(w[:9])), (4, item.upper().replace(" ", ", ")),
             (5, " ".join(w[i:i + 4][0] + " zz" for i in range(18))), (6, None), (None, item), (7, "one two three four " * 9), (8, item), (8, item)]
    items = bench(spark, [(70, item), (71, "few words"), (72, None), (None, "a b c d e f g h"), (70, item)])
    got = {(r.doc_id, r.contaminated, tuple(r["items"])) for r in decontam.decontaminate(frame(spark, texts), items).collect()}
    assert got == {(1, True, (70,)), (2, True, (70,)), (3, False, ()), (4, True, (70,)), (5, False, ()), (6, False, ()),
                   (None, True, (70,)), (7, False, ()), (8, True, (70,))}
    assert decontam.decontaminate(frame(spark, texts), items).count() == len(texts)
    kept = decontam.clean(frame(spark, texts), items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7] and kept.columns == empty.columns
    assert decontam.decontaminate(empty, items).collect() == [] and decontam.clean(empty, items).collect() == []
    nothing = decontam.decontaminate(frame(spark, texts), bench(spark, []))
    assert nothing.where("contaminated").count() == 0 and nothing.count() == len(texts)


def test_short_items(spark):
    """Items under five words are found whole, at any length, and not in parts."""
    texts = [(1, "x Few, words y"), (2, "few other words"), (3, "answer"), (4, "the answer is forty two."), (5, "answer is forty"), (6, None)]
    items = bench(spark, [(71, "few words"), (72, "ANSWER"), (73, "answer is forty two"), (74, "..."), (75, "a b c d e")])
    got = {r.doc_id: tuple(r["items"]) for r in decontam.decontaminate(frame(spark, texts), items).collect()}
    assert got == {1: (71,), 2: (), 3: (72,), 4: (72, 73), 5: (72,), 6: ()}


def test_op10_on_documents(spark):
    items = [(r.item_id, grams.words_of(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = {r.doc_id: tuple(r["items"]) for r in queries.op10_decontamination(spark, SMALL).collect()}
    assert len(got) == len(documents(spark))
    for i, text in documents(spark):
        words = grams.words_of(text)
        five = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
        found = []
        for j, item in items:
            if any(tuple(item[k:k + 5]) in five for k in range(len(item) - 4)):
                if sum(n for *_, n in plain_tiles(words, item, 5)) >= 0.8 * len(item):
                    found.append(j)
        assert got.get(i, ()) == tuple(sorted(found))


def test_shared_text_is_no_leak(spark):
    got = decontam.decontaminate(frame(spark, [(1, SHARED)]), bench(spark, [(1, "the quick brown fox jumps far away from home and never once comes back")]))
    assert not got.first().contaminated
