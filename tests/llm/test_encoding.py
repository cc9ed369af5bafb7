"""Encoding, cached counts and Arrow files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from recforge.llm import arrowfile, bpe, queries, tokencount, words
from recforge.llm.common import scratch

from .conftest import RUN, TEXTS, rows_of

WORD, BYTE = (words.tokenizer_path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
SMALL = "/root/testdata/sf0.001"


def library(path, text):
    return words.load(path).encode(text or "", add_special_tokens=False).ids


def digest(ids, path=WORD):
    text = words.load(path).decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_fast_encoders_give_the_librarys_ids(path):
    for _, text in TEXTS:
        assert words.encoder(path).ids(text or "").tolist() == library(path, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\t\x1c aBcé́İΣς'sdl.,!?<|>endoftx0123漢\U0001f600", max_size=60))
def test_fast_encoders_on_odd_texts(text):
    for path in (WORD, BYTE):
        assert words.encoder(path).ids(text).tolist() == library(path, text)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from(["abcdefghij", "aab", "ab!'s", "the", "0123a", "éèaç"]), st.integers(1, 400))
def test_joined_runs_equal_whole_runs(seed, alphabet, cut):
    rng = random.Random(seed)
    run = "".join(rng.choice(alphabet) for _ in range(cut + rng.randrange(1, 400)))
    for path in (WORD, BYTE):
        got = bpe.join_run(run[:cut], run[cut:], path, short=0, width=8)
        assert got.tolist() == library(path, run)


def by_tree(text, path, leaf):
    ends = bpe.cuts(len(text), leaf)
    pieces = [bpe.Piece.leaf(text[a:b], path) for a, b in zip([0, *ends], ends)]
    return bpe.tree(pieces, path).ids.tolist()


@pytest.mark.parametrize("leaf", [7, 100, 4000])
@pytest.mark.parametrize("path", [WORD, BYTE])
def test_tree_of_halves(path, leaf):
    for _, text in TEXTS:
        assert by_tree(text or "", path, leaf) == library(path, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="  \n aBcé́'sd.,!0漢\U0001f600", max_size=80), st.integers(1, 9))
def test_tree_of_odd_texts(text, leaf):
    for path in (WORD, BYTE):
        assert by_tree(text, path, leaf) == library(path, text)


def test_merge_pairs_decide_the_encoding():
    """What joins rely on: a token is its own encoding, so adjacent pairs decide."""
    tokenizer = words.load(BYTE)
    names = list(tokenizer.get_vocab().items())[:3000]
    for name, i in names:
        if i < 50256:
            assert [t.id for t in tokenizer.model.tokenize(name)] == [i]


@pytest.mark.parametrize("leaf", [64, bpe.LEAF])
def test_encode_rows(messy, leaf):
    got = rows_of(bpe.encode(messy, WORD, bpe.digests, bpe.DIGESTS_DDL, leaf), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((i, *digest(library(WORD, t))) for i, t in TEXTS), key=repr)


def test_byte_vocabulary_round_trip(messy):
    got = rows_of(bpe.encode(messy, BYTE, bpe.digests, bpe.DIGESTS_DDL, 64), "doc_id", "decoded_sha256")
    assert got == sorted(((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in TEXTS), key=repr)


def test_op1_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = rows_of(queries.op1_bpe(spark, SMALL), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((d.doc_id, *digest(library(WORD, d.text))) for d in docs), key=repr)


def test_counts_and_cache(spark, messy):
    cache = scratch(spark, "test-cache")
    expected = sorted(((i, len((t or "").encode()), len(library(BYTE, t))) for i, t in TEXTS), key=repr)
    first = messy.limit(8)
    tokencount.count_tokens(first, BYTE, cache).collect()
    held = tokencount.read_cache(spark, cache).count()
    assert held == first.select("text").distinct().count()
    assert rows_of(tokencount.count_tokens(messy, BYTE, cache), "doc_id", "n_bytes", "n_tokens") == expected
    stored = tokencount.read_cache(spark, cache)
    assert stored.count() == stored.select("content").distinct().count() == len({t or "" for _, t in TEXTS})
    tokencount.count_tokens(messy, BYTE, cache).collect()
    assert tokencount.read_cache(spark, cache).count() == stored.count()  # nothing was encoded again
    tokencount.count_tokens(messy, WORD, cache).collect()  # another tokenizer has counts of its own
    assert rows_of(tokencount.count_tokens(messy, BYTE, cache), "doc_id", "n_bytes", "n_tokens") == expected


def test_op7_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = rows_of(queries.op7_token_counts(spark, SMALL), "doc_id", "n_bytes", "n_tokens", "over_limit")
    n = {d.doc_id: len(library(BYTE, d.text)) for d in docs}
    assert got == sorted(((d.doc_id, len(d.text.encode()), n[d.doc_id], n[d.doc_id] > 512) for d in docs), key=repr)


@pytest.mark.parametrize("length,file_ids", [(2, 1000), (64, 1 << 25)])
def test_arrow_files(spark, messy, length, file_ids):
    folder = scratch(spark, "test-ids")
    index = arrowfile.write_ids(messy, BYTE, folder, length=length, file_ids=file_ids)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in arrowfile.read_digests(index).collect()))
    ids = {(i, t): np.array([*library(BYTE, t), 0], "<u4") for i, t in TEXTS}
    crc = sorted((str(i), len(x), zlib.crc32(x.tobytes())) for (i, t), x in ((k, ids[k]) for k in TEXTS))
    assert sorted((str(d), n, c) for _, d, n, c in got) == crc
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    order = [d for _, d, _, _ in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    files = {r.file for r in index.collect()}
    total = 0
    for path in files:
        reader = arrowfile.opened(path)
        for b in range(reader.num_record_batches):
            batch = reader.get_batch(b)
            assert batch.schema.field("ids").type.list_size == length
            total += int(np.array(batch.column(1).values).sum())  # the mask is true where an id is
    assert total == at


def test_op4_on_documents(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda d: d.doc_id)
    expected, at = [], 0
    for d in docs:
        x = np.array([*library(BYTE, d.text), 0], "<u4")
        expected.append((d.doc_id, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert rows_of(queries.op4_arrow_ids(spark, SMALL), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_empty(spark, empty):
    assert bpe.encode(empty, WORD, bpe.digests, bpe.DIGESTS_DDL).collect() == []
    assert tokencount.count_tokens(empty, BYTE, scratch(spark, "t")).collect() == []
    assert arrowfile.read_digests(arrowfile.write_ids(empty, BYTE, scratch(spark, "t"))).collect() == []


def test_long_run_uses_windows():
    assert len(RUN) > bpe.SHORT_RUN
    assert bpe.join_run(RUN[:2500], RUN[2500:], WORD).tolist() == library(WORD, RUN)
