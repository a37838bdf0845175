"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust a score.

Base kinds (email, ip, card, phone) are decided by their pattern and, for cards, the Luhn sum alone; they are
always reported. Further kinds are reported when their score reaches a threshold:

* ``iban``: two letters, two digits and 11 to 30 letters or digits, in blocks or not, whose mod-97 check is 1;
* ``ssn``: ddd-dd-dddd outside the number ranges never given out, with a word such as "ssn" nearby;
* ``digits``: other numbers of 7 to 19 digits with a word nearby that says what they are.

Every pattern runs in time proportional to the text: no two of its parts can share a run of characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns and their limits, as the contract states them.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "digits")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NUMBER = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
DIGIT = re.compile(r"[0-9]")

#: Score a proposed span starts from, by kind.
START = {"iban": 0.9, "ssn": 0.4, "digits": 0.1}
#: What a word within ``REACH`` characters before or after a span adds to the score of a kind.
CONTEXT = {
    "iban": {"iban": 0.1, "example": -0.3, "sample": -0.3},
    "ssn": {"ssn": 0.4, "social security": 0.4, "taxpayer": 0.3, "order": -0.2, "part": -0.2},
    "digits": {"account": 0.5, "passport": 0.5, "license": 0.4, "phone": 0.5, "tel": 0.4, "fax": 0.4, "isbn": -0.5, "order": -0.2},
}
CONTEXT_WORDS = {kind: {w: re.compile(rf"(?<![a-z]){w}(?![a-z])") for w in words} for kind, words in CONTEXT.items()}
REACH = 40
THRESHOLD = 0.5


def luhn(digits: str) -> bool:
    """Whether a number's last digit fits the others."""
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(doubled[int(d)] if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def mod97(text: str) -> bool:
    """Whether an account number's check digits fit it."""
    rest = 0
    for c in text[4:] + text[:4]:
        rest = int(f"{rest}{int(c, 36)}") % 97
    return rest == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Addresses: from each @ back over the local part (not into the last address) and on over the domain."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base kinds by start, then kind."""
    found = [(s, e, "email") for s, e in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
                found.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = digits_of(m.group()) if m.end() - m.start() <= 2 * CARD_DIGITS[1] else ""
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(digits_of(m.group())) <= PHONE_DIGITS[1]:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def score(text: str, start: int, end: int, kind: str) -> float:
    """How likely a proposed span is what it seems, from 0 to 1, by the words around it."""
    around = text[max(0, start - REACH) : start].lower() + "\n" + text[end : end + REACH].lower()
    out = START[kind] + sum(CONTEXT[kind][w] for w, pattern in CONTEXT_WORDS[kind].items() if pattern.search(around))
    return min(1.0, max(0.0, out))


def further_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of the further kinds, none overlapping a base span or an earlier one, by start."""
    if not DIGIT.search(text):
        return []
    proposed = [(m.start(), m.end(), "iban") for m in IBAN.finditer(text) if mod97(m.group().replace(" ", ""))]
    proposed += [(m.start(), m.end(), "ssn") for m in SSN.finditer(text) if m.group()[:3] not in ("000", "666") and m.group()[0] != "9"]
    proposed += [(m.start(), m.end(), "digits") for m in NUMBER.finditer(text) if m.end() - m.start() <= 38 and 7 <= len(digits_of(m.group())) <= 19]
    scored = [p for p in proposed if score(text, *p) >= THRESHOLD]
    out, taken = [], base
    for kind in KINDS[4:]:
        out += clear([p for p in scored if p[2] == kind], taken)
        taken = base + out
    return sorted(out)


def clear(spans: list[tuple], taken: list[tuple]) -> list[tuple]:
    """The spans, given in order and disjoint, that share no character with any of ``taken``."""
    out, other, end, k = [], sorted(taken), 0, 0
    for span in spans:
        while k < len(other) and other[k][0] < span[1]:
            end = max(end, other[k][1])
            k += 1
        if end <= span[0]:
            out.append(span)
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


RESULT = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def find_spans(text: str | None) -> tuple[list, list]:
    """Base spans and further spans ``(start, end, kind)`` in code points. Null is an empty text."""
    base = base_spans(text or "")
    return base, further_spans(text or "", base)


def masked(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets."""
    if text is None:
        return None
    base, further = find_spans(text)
    out, last = [], 0
    for start, end, kind in sorted(base + further):
        if start >= last:
            out += [text[last:start], f"<{kind}>"]
            last = end
    return "".join(out) + text[last:]


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            base, further = find_spans(text.as_py())
            counts = [sum(s[2] == kind for s in base) for kind in KINDS[:4]]
            rows.append((doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + further)))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts of base spans, their digest, and all spans.

    A null or empty text has no spans. Repeated rows, null ids and further columns change nothing: every row is
    judged by its own text alone, in one pass without a shuffle.
    """
    return docs.select("doc_id", "text").mapInArrow(_report, RESULT)
