"""Byte-pair encoding and decoding of whole texts; long ones by tree concatenation.

A text of more than ``leaf`` characters is cut in halves until the pieces are
short enough, wherever the middle falls: inside a word too.  The pieces are
rows, encoded in parallel, and neighbours are then joined level by level.

A join concerns only the run of characters that the cut falls into: tokens never
span a single space between other characters, so runs end there.  A short run is encoded anew.  For a long one, windows around the cut are
encoded, each twice as wide as the one before, until the window agrees exactly
with both sides: a token with the same place and id in the window and in the
left piece, and one in the window and in the right piece, that touch neither
the cut nor an end of the window.  Merges depend on neighbouring tokens only (a
sequence is the encoding if every adjacent pair is), so the left ids up to the
first such token, the window's between the two, and the right ids from there on
are the encoding of the whole.  A window that reaches the whole run is exact by
itself, as is a run with white space or not in normal form C, which is encoded whole.

Nulls: a null text is empty; its digests are those of no bytes.  Repeated rows
each get their row.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm import words

LEAF = 16_384  # characters of a piece
SHORT_RUN = 512  # characters of a run that is simply encoded again
WINDOW = 64  # characters on either side of a cut, at first


@lru_cache(4)
def decoder(path: str):
    """ids -> text, as the library's ``decode(ids, skip_special_tokens=False)``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    names = {i: t for t, i in spec["model"]["vocab"].items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
    if spec["decoder"] is None:  # the library joins the tokens by spaces
        return lambda ids: " ".join(map(names.__getitem__, ids.tolist()))
    if spec["decoder"]["type"] == "ByteLevel":
        byte = {c: b for b, c in enumerate(words.byte_alphabet())}
        raw = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for i, t in names.items()}
        return lambda ids: b"".join(map(raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
    tokenizer = words.load(path)
    return lambda ids: tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def cuts(n: int, leaf: int = LEAF) -> list[int]:
    """Ends of the pieces of n characters: halves of halves until none is longer than ``leaf``."""
    if n <= leaf:
        return [n]
    left = cuts(n // 2, leaf)
    return left + [n // 2 + x for x in cuts(n - n // 2, leaf)]


class Piece:
    """Ids of a stretch of text.  ``head`` and ``tail`` are the runs at its ends, up to the first and from
    the last safe cut, with their numbers of ids; in a piece without one they are the whole."""

    def __init__(self, ids, head, n_head, tail, n_tail, whole):
        self.ids, self.head, self.n_head, self.tail, self.n_tail, self.whole = ids, head, n_head, tail, n_tail, whole

    @classmethod
    def leaf(cls, text: str, path: str) -> Piece:
        encode = words.encoder(path).ids
        ids, safe = encode(text), [m.start() for m in words.CUT.finditer(text)]
        if not safe:
            return cls(ids, text, len(ids), text, len(ids), True)
        head, tail = text[:safe[0]], text[safe[-1]:]
        return cls(ids, head, len(encode(head)), tail, len(encode(tail)), False)


def spans(text: str, path: str) -> list[tuple[int, int, int]]:
    """(start, end, id) of the library's tokens."""
    e = words.load(path).encode(text, add_special_tokens=False)
    return [(a, b, i) for (a, b), i in zip(e.offsets, e.ids)]


def clean(tokens: list[tuple[int, int, int]]) -> dict[tuple[int, int, int], int]:
    """Index of the tokens that begin and end between characters."""
    return {t: i for i, t in enumerate(tokens) if (i == 0 or tokens[i - 1][1] <= t[0])
            and (i + 1 == len(tokens) or tokens[i + 1][0] >= t[1])}


def join_run(left: str, right: str, path: str, short: int = SHORT_RUN, width: int = WINDOW) -> np.ndarray:
    """Ids of the run ``left + right``."""
    run, cut = left + right, len(left)
    if len(run) > short and unicodedata.is_normalized("NFC", run) and "<|" not in run and not re.search(r"\s", run):
        a, b = spans(left, path), [(s + cut, e + cut, i) for s, e, i in spans(right, path)]
        left_at, right_at = clean(a), clean(b)
        while width < max(cut, len(run) - cut):
            lo, hi = max(0, cut - width), min(len(run), cut + width)
            w = [(s + lo, e + lo, i) for s, e, i in spans(run[lo:hi], path)]
            own = clean(w)
            first = next((t for t in own if t in left_at and lo < t[0] and t[1] < cut), None)
            last = next((t for t in reversed(own) if t in right_at and cut < t[0] and t[1] < hi), None)
            if first and last:
                ids = a[:left_at[first]] + w[own[first]:own[last]] + b[right_at[last]:]
                return np.array([i for _, _, i in ids], np.uint32)
            width *= 2
    return words.Library(path).ids(run)


def join(x: Piece, y: Piece, path: str) -> Piece:
    """The piece of two neighbours' texts."""
    middle = join_run(x.tail, y.head, path)
    ids = np.concatenate([x.ids[:len(x.ids) - x.n_tail], middle, y.ids[y.n_head:]])
    run = x.tail + y.head
    return Piece(ids, run if x.whole else x.head, len(middle) if x.whole else x.n_head,
                 run if y.whole else y.tail, len(middle) if y.whole else y.n_tail, x.whole and y.whole)


def tree(pieces: list[Piece], path: str) -> Piece:
    """Neighbours joined level by level."""
    while len(pieces) > 1:
        pieces = [join(*pieces[i:i + 2], path) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0]


_LEAVES = pa.schema([("key", pa.binary()), ("no", pa.int32()), ("ids", pa.binary()), ("head", pa.string()),
                     ("n_head", pa.int32()), ("tail", pa.string()), ("n_tail", pa.int32()), ("whole", pa.bool_())])
_LEAVES_DDL = "key binary, no int, ids binary, head string, n_head int, tail string, n_tail int, whole boolean"
_PIECES = pa.schema([("key", pa.binary()), ("no", pa.int32()), ("piece", pa.string())])


def encode(docs: DataFrame, tokenizer: str, summary, summary_ddl: str, leaf: int = LEAF) -> DataFrame:
    """``summary(ids, tokenizer)``, a dict of the columns of ``summary_ddl``, beside each row's doc_id.

    Rows of short texts never leave their task.  Long texts are reduced to
    distinct ones, so copies are encoded once, and their pieces are spread.
    """
    rows = C.texts(docs)
    names = [f.split(":")[0].strip() for f in summary_ddl.split(",")]
    ddl = summary_ddl.replace(":", " ")

    def frame(ids_list: list[np.ndarray]) -> list[pa.Array]:
        out = [summary(ids, tokenizer) for ids in ids_list]
        return [pa.array([x[n] for x in out]) for n in names]

    def short(batches):
        ids = words.encoder(tokenizer).ids
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *frame([ids(t) for t in batch.column(1).to_pylist()])], ["doc_id", *names])

    def cut(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ends = cuts(len(text), leaf)
                parts = [text[a:b] for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(parts), pa.binary()),
                                                  pa.array(range(len(parts)), pa.int32()), pa.array(parts)],
                                                 schema=_PIECES)

    def leaves(key, no, piece):
        made = [Piece.leaf(t, tokenizer) for t in piece.to_pylist()]
        return {"key": key, "no": no, "ids": [p.ids.astype("<u4").tobytes() for p in made]} | {
            n: [getattr(p, n) for p in made] for n in ("head", "n_head", "tail", "n_tail", "whole")}

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        pieces = [Piece(np.frombuffer(r["ids"], "<u4"), r["head"], r["n_head"], r["tail"], r["n_tail"], r["whole"])
                  for r in table.to_pylist()]
        return pa.Table.from_arrays([table["key"].slice(0, 1), *frame([tree(pieces, tokenizer).ids])], ["key", *names])

    long = rows.where(F.length("text") > leaf).withColumn("key", C.text_digest(F.col("text")))
    done = long.groupBy("key").agg(F.first("text").alias("text")).mapInArrow(cut, "key binary, no int, piece string") \
        .repartition("key", "no").mapInArrow(C.by_batch(leaves, _LEAVES, "key", "no", "piece"), _LEAVES_DDL) \
        .groupBy("key").applyInArrow(joined, f"key binary, {ddl}")  # a group is one text's pieces
    return rows.where(F.length("text") <= leaf).mapInArrow(short, f"doc_id bigint, {ddl}") \
        .unionByName(long.select("doc_id", "key").join(done, "key").drop("key"))


def digests(ids: np.ndarray, tokenizer: str) -> dict:
    """Number and digest of ids, and digest of the text that they decode to."""
    return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            "decoded_sha256": hashlib.sha256(decoder(tokenizer)(ids).encode()).hexdigest()}


DIGESTS_DDL = "n_tokens: bigint, ids_sha256: string, decoded_sha256: string"


def packed(ids: np.ndarray, tokenizer: str) -> dict:
    """The ids themselves, as little-endian unsigned 32-bit integers."""
    return {"n_tokens": len(ids), "ids": ids.astype("<u4").tobytes()}


PACKED_DDL = "n_tokens: bigint, ids: binary"
