"""The conversation trie against a plain one of nested dictionaries."""

import hashlib
import random
import zlib

import pytest
from recforge.llm import queries, trie

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
DDL = "conv_id bigint, turn bigint, role string, text string, n int, name string, tree int, key string, first int"


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5 if c >= 0 else c + -c % 5, [])[:heads[c]] + ts[heads[c]:] for c, ts in own.items()}


def plain_trie(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, cs in members.items()), key=repr)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "k", 3) for r in rows], DDL).repartition(3)


def random_rows(seed, n_convs, longest, words):
    """Conversations that share turns often, some of them copies, some long."""
    rng = random.Random(seed)
    rows, turns = [], []
    for c in rng.sample(range(-20, 3 * n_convs), n_convs):
        if not turns or rng.random() < 0.6:
            turns = [(rng.choice("ua"), rng.choice(words)) for _ in range(rng.choice([0, 1, 2, 5, longest]))]
        elif rng.random() < 0.5:
            turns = turns[:rng.randrange(len(turns) + 1)] + [("u", rng.choice(words))]
        rows += [(c, None if k == 0 else 2 * k, r, t) for k, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("base", [1, 4, 16])
def test_random(spark, base):
    rows = random_rows(base, 120, 40, ["", "hello", "é", "漢字", "a longer text " * 3, None])
    df = trie.conversation_trie(frame(spark, rows), base=base)
    assert got(df) == plain_trie(plain_rebuilt(rows))


def test_many_rounds(spark):
    """A path of 70 turns with branches at every depth: seven rounds of cuts and grafts."""
    rng = random.Random(2)
    path = [("u", f"turn {k % 7}") for k in range(70)]
    convs = {c: path[:rng.randrange(71)] + [("a", "x" * rng.randrange(4))] * rng.randrange(3) for c in range(60)}
    seqs = trie.sequences(frame(spark, [(c, k, *t) for c, ts in convs.items() for k, t in enumerate(ts)]))
    assert got(trie.prefix_trie(seqs, base=1)) == plain_trie({c: ts for c, ts in convs.items() if ts})


def test_messy(spark):
    """Nulls everywhere, repeated rows, conversations that lose all their turns, and a copy group."""
    rows = [(None, 1, "u", "nobody's"), (0, None, None, None), (0, None, None, None), (0, 3, "u", None), (3, 1, "u", "x" * 100000), (7, 1, "u", "b")]
    rows += [(c, k, "u", "same") for c in range(1000, 1200) for k in range(12)] + [(c, 0, "u", "only") for c in (2001, 2003, 2004, 2007)]
    assert any(not ts for ts in plain_rebuilt(rows).values())
    assert got(trie.conversation_trie(frame(spark, rows))) == plain_trie(plain_rebuilt(rows))


def test_strung_over_tasks(spark):
    """A node's ids come from several pieces and several ranges."""
    rows = [(c, 0, "u", "one") for c in range(0, 9000, 5)]
    assert got(trie.conversation_trie(frame(spark, rows))) == plain_trie(plain_rebuilt(rows))


def test_empty(spark):
    assert trie.conversation_trie(spark.createDataFrame([], DDL)).collect() == []
    assert trie.conversation_trie(frame(spark, [(None, 1, "u", "t")])).collect() == []


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert got(queries.op11_conversation_trie(spark, SMALL)) == plain_trie(plain_rebuilt(rows))
