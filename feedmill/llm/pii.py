"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk

# The kinds in their order; the first four are always kept once they pass their own test.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
#: Spans below this score are not reported.
THRESHOLD = 0.5
#: Characters before and after a span in which its context words count.
CONTEXT = 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# A run of digits matches from its first digit or not at all, so later starts need no try.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+-])\(?[0-9]{3}\)?[\x20-][0-9]{3}-[0-9]{4}(?![0-9-])")

# Words that speak for a kind, and words that speak against any.
_FOR = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "tel", "telephone", "call", "mobile", "fax"),
}
_AGAINST = frozenset(("example", "sample", "dummy", "version", "isbn", "serial"))
_BASE_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.5, "phone": 0.7, "iban": 0.4, "ssn": 0.3, "local_phone": 0.3}
_CONFIRMED = 0.3
_CONTEXT_WORD = 0.25
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)?")

_OUT = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>"


def luhn(digits: str) -> bool:
    """Whether a digit string ends in its Luhn check digit."""
    doubled = str.maketrans("0123456789", "0246813579")
    odd, even = digits[-1::-2], digits[-2::-2].translate(doubled)
    return sum(map(int, odd + even)) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number in ISO 13616 form (no spaces) leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Places of valid account numbers.  Capitals after one may match as its last groups, so shorter ends count too."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 1
        ends = [m.end(), *(k for k in range(m.end() - 1, m.start(), -1) if text[k] == " ")]
        for end in ends:
            account = text[m.start() : end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                yield m.start(), end
                at = end
                break


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, confirmed by a checksum) of every span that a pattern and its own test let through."""
    for start, end in _emails(text):
        yield "email", start, end, False
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        if len(m[0]) >= 12 and 12 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield "card", m.start(), m.end(), True
    phones = []
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            phones.append((m.start(), m.end()))
            yield "phone", m.start(), m.end(), False
    for start, end in _accounts(text):
        yield "iban", start, end, True
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", m.start(), m.end(), False
    for m in _LOCAL_PHONE.finditer(text):
        if not any(s < m.end() and m.start() < e for s, e in phones):
            yield "local_phone", m.start(), m.end(), False


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    """What the pattern is worth, more with a checksum, more or less by words nearby; from 0 to 1."""
    near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    words = set(_WORD.findall(near.lower()))
    value = _BASE_SCORE[kind] + _CONFIRMED * confirmed
    value += _CONTEXT_WORD * bool(words & set(_FOR[kind])) - _CONTEXT_WORD * bool(words & _AGAINST)
    return round(min(1.0, max(0.0, value)), 2)


def spans_of(text: str) -> list[dict]:
    out = []
    for kind, start, end, confirmed in proposals(text):
        value = score(text, kind, start, end, confirmed)
        if value >= THRESHOLD or KINDS.index(kind) < 4:
            out.append({"kind": kind, "start": start, "end": end, "score": value})
    return sorted(out, key=lambda x: (x["start"], KINDS.index(x["kind"])))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    for part in tk.slices(batches):
        out = [spans_of(text or "") for text in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.list_(kind))], names=["doc_id", "spans"])


def find_pii(documents: DataFrame) -> DataFrame:
    """doc_id and the spans found, by start, then kind; one row for each row of documents.

    Starts and ends count code points, ends are exclusive.  A NULL text is empty.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan, _OUT)
