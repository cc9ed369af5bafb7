"""Quality rules as a short-circuit cascade.

A rule is a predicate that rejects a document.  On a sample, each rule's cost
(seconds a document, with whatever it must compute) and selectivity (share it
rejects) are measured; rules then run in order of rejections per cost, and a
document leaves the cascade at the first rule that rejects it.  What rules
compute of a document is computed once and only if a rule gets there.  The
order changes the work, never the verdict: a document is kept if no rule
rejects it.

Nulls: a null text has no words, so it is rejected for having too few.
Repeated rows are judged one by one.  Empty table: no rows; the rules then keep
their given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C

SAMPLE = 1000  # documents, about, on which costs and selectivities are measured
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


class Doc:
    """Lazy measures of one text.  Words are what white space of ASCII separates."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_lettered(self) -> int:
        """Words with a letter of ASCII or a character beyond it."""
        return sum(1 for w in self.words if not w.isascii() or w.upper() != w.lower())

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of three words that are found twice or more."""
        n = len(self.words)
        if n < 4:
            return 0
        index: dict[bytes, int] = {}
        ids = np.array([index.setdefault(w, len(index)) for w in self.words], np.int64)
        pairs = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * np.int64(len(index)) + ids[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        twice, covered = np.zeros(n - 2, bool), np.zeros(n, bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        for k in range(3):
            covered[k:n - 2 + k] |= twice
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]


BASE_RULES = (
    Rule("few_words", lambda d: d.n_words < 50),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda d: 100 * d.n_symbols > 30 * d.n_words),
    Rule("repeated_lines", lambda d: 100 * d.n_dup_lines > 30 * len(d.lines)),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("few_letters", lambda d: 2 * d.n_lettered < d.n_words),
)


def measure_rules(docs: DataFrame, rules: Iterable[Rule] = RULES, size: int = SAMPLE) -> DataFrame:
    """(rule, n, rejected, seconds) over a sample of about ``size`` rows, each rule by itself."""
    rules = tuple(rules)
    schema = pa.schema([("rule", pa.string()), ("n", pa.int64()), ("rejected", pa.int64()), ("seconds", pa.float64())])

    def measure(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = []
            for rule in rules:
                began = time.perf_counter()
                rejected = sum(rule.rejects(Doc(t)) for t in texts)
                out.append((rule.name, len(texts), rejected, time.perf_counter() - began))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    share = min(1.0, size / max(1, docs.count()))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    return C.texts(docs).where(place < int(share * (1 << 40))) \
        .mapInArrow(measure, "rule string, n bigint, rejected bigint, seconds double") \
        .groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("n", "rejected", "seconds")))


def ordered(docs: DataFrame, rules: Iterable[Rule] = RULES, size: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per second of work, most first: one row a rule reaches the driver."""
    worth = {r.rule: r.rejected / max(r.seconds, 1e-9) for r in measure_rules(docs, rules, size).collect()}
    return sorted(rules, key=lambda rule: -worth.get(rule.name, 0.0))


def first_rejecting(doc: Doc, rules: Iterable[Rule]) -> str | None:
    return next((rule.name for rule in rules if rule.rejects(doc)), None)


def judge(docs: DataFrame, rules: Iterable[Rule] = RULES, measures: tuple[str, ...] = (),
          size: int = SAMPLE) -> DataFrame:
    """(doc_id, rejected_by, kept, measures...) for each row; ``measures`` are integer properties of ``Doc``.

    ``rejected_by`` names the rule that was first in this run's order.
    """
    cascade = ordered(docs, rules, size)
    schema = pa.schema([("doc_id", pa.int64()), ("rejected_by", pa.string()), ("kept", pa.bool_()),
                        *((m, pa.int64()) for m in measures)])

    def run(doc_id, text):
        made = [Doc(t) for t in text.to_pylist()]
        by = [first_rejecting(d, cascade) for d in made]
        return {"doc_id": doc_id, "rejected_by": by, "kept": [b is None for b in by]} | {
            m: [getattr(d, m) for d in made] for m in measures}

    return C.texts(docs).mapInArrow(
        C.by_batch(run, schema, "doc_id", "text"),
        "doc_id bigint, rejected_by string, kept boolean" + "".join(f", {m} bigint" for m in measures))


def keep(docs: DataFrame, rules: Iterable[Rule] = RULES, size: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they are."""
    cascade = ordered(docs, rules, size)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            mask = [first_rejecting(Doc(t or ""), cascade) is None for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
