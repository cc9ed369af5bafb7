"""Exact byte-pair encoding of whole texts, with the tokenizers library's results.

The library spends about a second on each megabyte, most of it on words it has
met before and on offsets nobody reads.  Two faster ways give the same ids:

* A byte-level vocabulary whose ids are its merge ranks is handed to tiktoken.
  Whether the ids are the ranks is checked against the merges in the file.
* For a vocabulary with word ends, white space is dropped and no token spans
  it, so texts are cut there and the ids of each piece are remembered.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

# Python's white space that the tokenizers don't take for white space.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
# Spaces before which every token of either kind of vocabulary ends.
CUT = re.compile(r"(?<=\S) (?=\S)")
MARKS = ",.;:!?"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(4)
def load(path: str):
    """The tokenizer of a .json file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def version(path: str) -> str:
    """Digest of a tokenizer: its file, the library's version and the options used."""
    import tokenizers
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"|tokenizers {tokenizers.__version__}|no special".encode()).hexdigest()


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes take the
    characters from U+0100 on, in order.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Library:
    """The library itself; the other encoders give the same ids sooner."""

    def __init__(self, path: str):
        self.tokenizer = load(path)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


class Ranks(Library):
    """Byte-level vocabularies without normalizer whose ids are ranks, by tiktoken."""

    @staticmethod
    def fits(spec: dict) -> bool:
        model, vocab = spec["model"], spec["model"]["vocab"]
        split = spec["pre_tokenizer"] or {}
        joined = ("".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"])
        return (spec["normalizer"] is None and split.get("type") == "ByteLevel" and split["use_regex"]
                and not split["add_prefix_space"] and not model["end_of_word_suffix"]
                and all(vocab[m] == 256 + i for i, m in enumerate(joined))
                and not any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]))

    def __init__(self, path: str, spec: dict):
        super().__init__(path)
        import public_tokenizers
        import tiktoken
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding(f"ranks:{path}", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, allowed_special="all")


class Memo(dict):
    """Piece -> packed ids, bounded to two generations of ``size`` entries.

    The younger generation takes every value used; when it is full it becomes
    the older one, so what is still in use survives and the rest is dropped.
    """

    def __init__(self, value, size: int, longest: int = 64):
        super().__init__()
        self.value, self.size, self.longest, self.old = value, size, longest, {}
        self.marks = {mark: value(mark) for mark in MARKS}

    def __missing__(self, piece: str) -> bytes:
        mark = self.marks.get(piece[-1:])
        if mark is not None and piece[:-1].lower().isalpha():  # two runs, and so the ids of both
            return self[piece[:-1]] + mark
        value = self.old.get(piece) or self.value(piece)
        if len(piece) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[piece] = value
        return value


class WordEnds(Library):
    """Lower-casing vocabularies with word ends and dropped white space, piece by piece."""

    def __init__(self, path: str, size: int = 300_000):
        super().__init__(path)
        tokenize, alphabet = self.tokenizer.model.tokenize, dict(enumerate(byte_alphabet()))

        def value(piece: str) -> bytes:
            if piece.isascii():
                piece = piece.lower()
            if piece.isalpha() and piece.islower() and unicodedata.is_normalized("NFC", piece):
                # One run of letters that the normalizer leaves alone: straight to the merges.
                piece = piece.encode().decode("latin-1").translate(alphabet)
                return np.array([t.id for t in tokenize(piece)], "<u4").tobytes()
            return Library.ids(self, piece).tobytes()

        self.memo = Memo(value, size)

    def ids(self, text: str) -> np.ndarray:
        pieces = [x for x in text.split(" ") if x] if _NOT_SPACE.search(text) else text.split()
        return np.frombuffer(b"".join(map(self.memo.__getitem__, pieces)), "<u4")


@lru_cache(8)
def encoder(path: str) -> Library:
    """The fastest encoder that fits; one for each Python worker, so its memo serves all the worker's tasks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if Ranks.fits(spec):
        return Ranks(path, spec)
    if spec["model"]["end_of_word_suffix"] and spec["decoder"] is None:
        return WordEnds(path)
    return Library(path)
