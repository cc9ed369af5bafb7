"""Personal data: expressions propose spans, checksums confirm them, context adjusts the score.

Places are code points, ends exclusive.  Each kind's matches are leftmost and
don't overlap; a match that its validator refuses is dropped without another
try at the same place.  Account numbers alone are cut first, to the length that
their country fixes or, if none is known, to the longest groups that pass; the
search goes on behind the cut, or at the next group if nothing passes.  The kinds of ``BASE`` are always reported once valid.
The others are reported if their score reaches ``THRESHOLD`` and they overlap
no base span: a shape alone scores ``SHAPE``, a confirmed checksum ``CHECKED``, and
words of the kind's context within ``NEAR`` characters add ``CONTEXT``, words
that speak against it take it off.

Every expression moves through a text once: none begins inside a run that it
has already refused, but for account numbers, whose runs have at most 67 characters.

Nulls: a null text is empty and has no spans.  Repeated rows are searched one
by one.  Empty table: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C

SHAPE, CHECKED, CONTEXT, THRESHOLD = 0.4, 0.7, 0.3, 0.6
NEAR = 40  # characters on either side


def luhn(digits: str) -> bool:
    """Whether the digits pass the check of payment card numbers."""
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number (letters and digits, country first) passes ISO 7064 mod 97-10."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def digits_of(match: str) -> str:
    return "".join(c for c in match if "0" <= c <= "9")


def card(match: str) -> bool:
    digits = digits_of(match)
    return 13 <= len(digits) <= 19 and luhn(digits)


def social(match: str) -> bool:
    area, group, serial = match.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of addresses: every sign @ with a domain, and what may stand before it back to the last span."""
    spans, end = [], 0
    for match in DOMAIN.finditer(text):
        start = match.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < match.start():
            spans.append((start, match.end()))
            end = match.end()
    return spans


ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
# Letters and digits of an account number, by country.
LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}


def account_end(match: str) -> int | None:
    """Where the account number that ``match`` begins with ends: at the end of a group, after its country's length."""
    ends = [i for i in range(len(match), 14, -1) if i == len(match) or match[i] == " "]
    length = LENGTHS.get(match[:2])
    for end in ends:
        number = match[:end].replace(" ", "")
        if (len(number) == length if length else len(number) >= 15) and mod97(number):
            return end
    return None


def accounts(text: str) -> list[tuple[int, int]]:
    """Spans of account numbers."""
    spans, at = [], 0
    while match := ACCOUNT.search(text, at):
        end = account_end(match[0])
        if end:
            spans.append((match.start(), match.start() + end))
        at = match.start() + (end or 1)
    return spans


@dataclass(frozen=True)
class Kind:
    name: str
    sign: re.Pattern  # a text without it has no match
    pattern: re.Pattern | Callable[[str], list[tuple[int, int]]]  # or a function that gives the spans
    valid: Callable[[str], bool] = lambda match: True
    checked: bool = True
    words: frozenset[str] = field(default=frozenset())
    against: frozenset[str] = field(default=frozenset())

    def spans(self, text: str) -> list[tuple[int, int]]:
        if not self.sign.search(text):
            return []
        if not isinstance(self.pattern, re.Pattern):
            return self.pattern(text)
        return [m.span() for m in self.pattern.finditer(text) if self.valid(m[0])]


_DIGIT = re.compile("[0-9]")
BASE = (
    Kind("email", re.compile("@"), emails, words=frozenset({"mail", "email", "contact"})),
    Kind("ip", _DIGIT, re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
         lambda m: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.split(".")),
         words=frozenset({"ip", "address", "host", "server"}), against=frozenset({"version", "section"})),
    Kind("card", _DIGIT, re.compile(r"[0-9](?:[\x20-]?[0-9])+"), card,
         words=frozenset({"card", "visa", "mastercard", "credit", "payment"}), against=frozenset({"isbn", "order"})),
    Kind("phone", re.compile(r"\+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
         lambda m: 9 <= len(digits_of(m)) <= 15,
         words=frozenset({"phone", "tel", "telephone", "call", "mobile", "fax"})),
)
MORE = (
    Kind("iban", _DIGIT, accounts, words=frozenset({"iban", "account", "bank", "konto", "compte", "cuenta"})),
    Kind("ssn", _DIGIT, re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), social, checked=False,
         words=frozenset({"ssn", "social", "security"}), against=frozenset({"order", "part", "isbn", "version"})),
    Kind("local_phone", _DIGIT, re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])"),
         checked=False, words=frozenset({"phone", "tel", "telephone", "call", "mobile", "fax"}),
         against=frozenset({"order", "part", "isbn", "version"})),
)
_WORD = re.compile("[a-z]+")


def score(kind: Kind, text: str, start: int, end: int) -> float:
    """Between 0 and 1: the check's worth, and what the words nearby say."""
    near = set(_WORD.findall(text[max(0, start - NEAR):start].lower())) | set(_WORD.findall(text[end:end + NEAR].lower()))
    value = CHECKED if kind.checked else SHAPE
    return round(min(1.0, max(0.0, value + CONTEXT * bool(near & kind.words) - CONTEXT * bool(near & kind.against))), 3)


def search(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by kind as listed, then start."""
    found = [(k.name, s, e, score(k, text, s, e)) for k in BASE for s, e in k.spans(text)]
    base = [(s, e) for _, s, e, _ in found]
    for k in MORE:
        for s, e in k.spans(text):
            if all(e <= a or b <= s for a, b in base) and (value := score(k, text, s, e)) >= threshold:
                found.append((k.name, s, e, value))
    return found


SPAN_DDL = "kind string, start int, end int, score double"
_SPANS = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans) for each row."""
    def run(doc_id, text):
        return {"doc_id": doc_id, "spans": [
            [dict(zip(("kind", "start", "end", "score"), s)) for s in search(t, threshold)] for t in text.to_pylist()]}

    return C.texts(docs).mapInArrow(C.by_batch(run, _SPANS, "doc_id", "text"),
                                    f"doc_id bigint, spans array<struct<{SPAN_DDL.replace(' ', ':').replace(',:', ',')}>>")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))


def of_kinds(spans: Column, kinds: tuple[Kind, ...]) -> Column:
    return F.filter(spans, lambda s: s.kind.isin([k.name for k in kinds]))


def masked(text: str, threshold: float = THRESHOLD) -> str:
    """The text with each span replaced by its kind; of overlapping spans, one mark for all."""
    spans = sorted((s, e, k) for k, s, e, _ in search(text, threshold))
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with personal data in ``text`` masked, and ``n_chars``, if it is there, brought up to date."""
    at, names = docs.columns.index("text"), docs.columns

    def run(batches):
        for batch in batches:
            text = [t and masked(t, threshold) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(text, batch.schema.field(at).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array([n if t is None else len(t) for t, n in zip(text, columns[k].to_pylist())],
                                      batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
