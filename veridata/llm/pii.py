"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust a score.

Four base kinds (email, ip, card, phone) are always reported when their pattern and checksum hold. Two more kinds come
from the same three steps: ``iban`` (country length, mod-97) and ``ssn`` (shape, then context words must lift its score
over ``MIN_SCORE``). Every search is linear in the text: no pattern can start twice inside one run of characters.

Null or empty text gives no spans. Repeated rows are treated one by one. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import per_document, slices

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
MIN_SCORE = 0.5
CONTEXT_CHARS = 48

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[\x20A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Lengths of account numbers by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26,
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": {"mail": 0.1, "contact": 0.1, "@example": -0.1},
    "ip": {"ip": 0.2, "address": 0.2, "host": 0.1, "server": 0.1, "version": -0.4},
    "card": {"card": 0.2, "visa": 0.2, "credit": 0.2, "payment": 0.1, "isbn": -0.3},
    "phone": {"phone": 0.3, "tel": 0.3, "call": 0.2, "fax": 0.2, "mobile": 0.3},
    "iban": {"iban": 0.1, "account": 0.1, "bank": 0.1},
    "ssn": {"ssn": 0.5, "social security": 0.5, "taxpayer": 0.3},
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The mod-10 checksum with every second digit from the right doubled."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += sum(divmod(2 * d, 10)) if i % 2 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Account-number checksum: four leading signs go last, letters count from 10, the remainder by 97 is 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL_CHARS:
            first -= 1
        m = _DOMAIN.match(text, at + 1) if first < at else None
        # a run that holds no match is not walked twice: the next one starts after this sign
        done = m.end() if m else at + 1
        if m:
            yield first, m.end()
        at = text.find("@", done)


def _ibans(text: str):
    done = 0
    for m in _IBAN.finditer(text):
        want = IBAN_LENGTH.get(m[0][:2])
        if want is None or m.start() < done:
            continue
        signs, i = "", m.start()
        while i < len(text) and len(signs) < want:
            c = text[i]
            if "0" <= c <= "9" or "A" <= c <= "Z":
                signs += c
            elif c != " " or text[i - 1] == " ":
                break
            i += 1
        if len(signs) == want and not text[i : i + 1].isalnum() and mod97(signs):
            done = i
            yield m.start(), i


def _scored(text: str, kind: str, start: int, end: int) -> Span:
    near = text[max(0, start - CONTEXT_CHARS) : start].lower()
    score = PRIOR[kind] + sum(v for w, v in CONTEXT[kind].items() if w in near)
    return Span(kind, start, end, round(min(1.0, max(0.0, score)), 3))


def find_spans(text: str | None) -> list[Span]:
    """All confirmed spans by kind in the order of KINDS, then by start."""
    text = text or ""
    out = [_scored(text, "email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append(_scored(text, "ip", *m.span()))
    for m in _CARD.finditer(text):
        # a long chain is never turned into a digit string: 19 digits span 37 signs at most
        if m.end() - m.start() <= 37 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(_scored(text, "card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append(_scored(text, "phone", *m.span()))
    out += [_scored(text, "iban", a, b) for a, b in _ibans(text)]
    out += [s for m in _SSN.finditer(text) if (s := _scored(text, "ssn", *m.span())).score >= MIN_SCORE]
    return out


def redact(text: str | None, spans: list[Span]) -> str:
    """The text with each span, or union of overlapping spans, replaced by its first kind in brackets."""
    text, out, done = text or "", [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= done:
            out += [text[done : s.start], f"[{s.kind.upper()}]"]
        done = max(done, s.end)
    return "".join([*out, text[done:]])


def detect_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, pii array<struct<kind, start, end, score>>, redacted string; a narrow scan.

    Null text: no spans, redacted is empty. Other columns are ignored.
    """

    def row():
        def one(t: str) -> tuple:
            spans = find_spans(t)
            return [s._asdict() for s in spans], redact(t, spans) if spans else t

        return one

    return per_document(docs, row, "pii array<struct<kind:string,start:int,end:int,score:double>>, redacted string", doc_id, text)


def _join(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans and all spans as text, for each document."""

    def row():
        def one(t: str) -> tuple:
            spans = find_spans(t)
            base = [s for s in spans if s.kind in KINDS[:4]]
            n = [sum(s.kind == k for s in base) for k in KINDS[:4]]
            return *n, hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans), max((s.score for s in spans), default=0.0)

        return one

    return per_document(docs, row, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, top_score double")


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced and n_chars brought up to date. A narrow map: null texts stay null, repeated
    rows stay as often as they are, and all other columns stay as they are; an empty table stays empty."""

    i = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in slices(batches, i):
            new = [None if t is None else redact(t, s) if (s := find_spans(t)) else t for t in b.column(i).to_pylist()]
            yield b.set_column(i, b.schema.field(i), pa.array(new, b.schema.field(i).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
