"""The filter audit against running every order of the filters."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from recforge.llm import audit, queries

from .conftest import LONG, TEXTS, frame

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_fails(rows):
    """The set of failed filters of each (doc_id, text) row, by the filters' definitions."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({f for f, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)), ("D", bool(re.search(r"[#$%&*|]", t))),
            ("E", i is not None and i > least[t])) if bad})
    return out


def plain_audit(rows, labels):
    """rows: (doc_id, text, part); labels: (doc_id, quality, toxic)."""
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    docs = [(p or "", i, fails) for (i, _, p), fails in zip(rows, plain_fails([(i, t) for i, t, _ in rows]))]
    found = {}
    for part in {p for p, _, _ in docs}:
        own, by_order = [(i, f) for p, i, f in docs if p == part], {}
        for order in itertools.permutations("ABCDE"):
            left, seen = own, []
            for k, f in enumerate(order):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                earlier = sum(1 for _, x in own if f in x and x & set(seen))
                seen.append(f)
                by_order["".join(order), k + 1] = (f, len(left), len(gone), earlier, sum(x == {f} for _, x in own),
                                                   sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
        total = collections.Counter()
        for f, _, gone, *_ in by_order.values():
            total[f] += gone
        found |= {(part, *key): (*v[1:], total[v[0]]) for key, v in by_order.items()}
    return found


def got(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    out = {r[:3]: r[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_popcounts():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 7, 1000):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        times = rng.integers(0, 70, n)
        bits = (words[:, None] >> np.arange(32, dtype=np.uint32)) & 1
        assert audit.popcounts(words).tolist() == bits.sum(0).tolist()
        assert audit.popcounts(words, times).tolist() == (bits * times[:, None]).sum(0).tolist()


def test_survival_words():
    for mask in range(32):
        for subset in range(32):
            assert (int(audit.WORDS[mask]) >> subset) & 1 == (mask & subset == 0)


@pytest.mark.parametrize("which", ["messy", "random", "empty"])
def test_small_tables(spark, which):
    rng = random.Random(8)
    texts = {"messy": TEXTS, "empty": [], "random": [
        (rng.choice([None, *range(40)]), rng.choice([None, "", "Ab", "word " * 250, LONG, LONG + "#", "a # b", "Q W " * 99]))
        for _ in range(300)]}[which]
    labels = [(rng.choice([None, *range(20)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(40)]
    docs = frame(spark, texts)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int") \
        .selectExpr("*", "'x' as part", "1 as mask", "2 as rows", "'s' as source")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got(audit.audit(docs, table)) == plain_audit(rows, labels)


def test_documents(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    plain = plain_audit(rows, [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert got(queries.op13_audit(spark, SMALL)) == plain and len(plain) == 600 * len({p for *_, p in rows})
    kept = {k[1:]: v for k, v in plain.items() if k[0] == rows[0][2]}
    assert len({v[0] for (_, step), v in kept.items() if step == 5}) == 1  # all orders end alike
