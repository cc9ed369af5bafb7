"""The pipeline's stages, each against a plain version on its own input."""

import re

import __spark_entry__ as entry
import corpus_pipeline as pipeline
import numpy as np
from recforge.llm import decontam, grams, words
from recforge.llm.common import written

from .conftest import TEXTS, frame
from .test_corpus import plain_components, plain_fingerprint, plain_tiles
from .test_filters import plain_measures, plain_pii

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "encoding"]


def plain_quality(text):
    """Whether every rule is passed, from the measures' plain versions."""
    n, chars, symbols, dup, repeats = plain_measures(text)
    words_ = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = sum(1 for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    lettered = sum(1 for w in words_ if re.search(r"[A-Za-z]|[^\x00-\x7f]", w))
    return not (n < 50 or 100 * repeats > 50 * n or 100 * symbols > 30 * n or 100 * dup > 30 * lines
                or not 2 * n <= chars <= 20 * n or 2 * lettered < n)


def plain_leak(text, items):
    """Whether an item's words are covered to 0.8 by greedy tiles of five words or more."""
    doc = grams.words_of(text or "")
    runs = {tuple(doc[i:i + 5]) for i in range(len(doc) - 4)}
    for item in items:
        if any(tuple(item[i:i + 5]) in runs for i in range(len(item) - 4)):
            if sum(n for *_, n in plain_tiles(doc, item, decontam.K)) >= 0.8 * len(item):
                return True
    return False


def test_stages(spark):
    items = [grams.words_of(r.text or "") for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = written(stage(spark, docs, SMALL), f"test-{name}")
        after = [r for r in docs.collect()]
        texts = [(r[0], r[1]) for r in before]
        if name != "encoding":
            assert docs.columns == columns
            ids = {r.doc_id for r in after}
        if name == "quality_rules":
            assert ids == {i for i, t in texts if plain_quality(t)}
        elif name == "near_duplicates":
            parts = plain_components([plain_fingerprint(t) for _, t in texts], [i for i, _ in texts])
            assert ids == set(parts) and len(after) == len(ids)
        elif name == "decontamination":
            assert ids == {i for i, t in texts if not plain_leak(t, items)} and len(ids) < len(texts)
        elif name == "personal_data":
            old = dict(texts)
            for r in after:
                assert not plain_pii(r.text) and r.n_chars == len(r.text)
                assert plain_pii(old[r.doc_id]) or r.text == old[r.doc_id]
        else:
            tokenizer = words.load(words.tokenizer_path("word_bpe_49k.json"))
            for r in after:
                assert np.frombuffer(r.ids, "<u4").tolist() == tokenizer.encode(dict(texts)[r.doc_id], add_special_tokens=False).ids


def test_run_is_the_stages(spark):
    assert pipeline.run(spark, SMALL).count() > 100


def test_messy_and_empty(spark):
    for texts in (TEXTS, []):
        docs = frame(spark, texts)
        for name, stage in pipeline.STAGES:
            docs = written(stage(spark, docs, SMALL), f"test-{name}")
        assert bool(docs.count()) == bool(texts)
