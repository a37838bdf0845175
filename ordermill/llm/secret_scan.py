"""Secrets in source and configuration text.

Base kinds are decided by patterns: ``assign``, ``access``, ``hex``. Beyond them the text is lexed into
name-literal pairs: assignments (``name = literal``, ``"name": literal``, ``name := "a" + OTHER``), whose names and
quoted or bare literals are read token by token. Constants are propagated: a name on the right stands for the literal
it was last given, and literals joined by ``+`` are taken together. A pair is reported as ``literal`` when the words
of its target name and the literal's own mix of characters score high enough.

The lexer reads every character a bounded number of times.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm.pii import clear

# The base patterns and their limits, as the contract states them.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

#: Score of a target name by the words it is made of.
NAME_WORDS = {
    "password": 0.7, "passwd": 0.7, "pwd": 0.7, "passphrase": 0.7, "secret": 0.7, "token": 0.6, "apikey": 0.7,
    "key": 0.4, "private": 0.3, "access": 0.2, "auth": 0.4, "credential": 0.6, "credentials": 0.6, "salt": 0.3,
    "api": 0.2, "client": 0.1, "signature": 0.4, "bearer": 0.5, "public": -0.4, "name": -0.4, "path": -0.5,
    "file": -0.5, "url": -0.4, "id": -0.1, "count": -0.6, "length": -0.6, "type": -0.5,
}
#: Literals that only stand in for a secret.
STAND_IN = re.compile(r"(?i)\A(?:x+|\*+|changeme|example|placeholder|none|null|true|false|your[_-].*|<.*>|\$\{.*\})\Z")
THRESHOLD = 0.8

NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
PAIR = re.compile(rf"""(?<![A-Za-z0-9_.-])(?:({NAME})|"({NAME})"|'({NAME})')[ \t]*+(?::=|=>|[:=])(?!=)[ \t]*+""")
PIECE = re.compile(rf""""([^"\\\n]*)"|'([^'\\\n]*)'|({NAME}|[A-Za-z0-9+/_.=-]+)""")
PLUS = re.compile(r"[ \t]*\+[ \t]*")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """How strongly a name says that its value is secret: the sum over its words, 0 to 1."""
    parts = [w.lower() for w in WORD.findall(name)]
    return min(1.0, max(0.0, sum(NAME_WORDS.get(w, 0.0) for w in parts)))


class Value:
    """A literal as it is put together: its first and last characters, length and how often it has each character.

    That is all a score takes, so what a document makes of its constants is never built beyond ``KEPT`` characters,
    whatever their sum is; it takes room for its distinct characters. Counts are of units of 2 ** ``scale`` characters, so that
    doubling a constant over and over doesn't lengthen them: the scale leaves 0 only where a unit is under the precision of a score.
    """

    def __init__(self, *parts: "str | Value"):
        self.length, self.counts, self.scale, self.head, self.tail, self.text = 0, Counter(), 0, "", "", ""
        for part in parts:
            self.add(part)

    def add(self, part: "str | Value") -> None:
        if isinstance(part, str):
            length, counts, scale, head, tail, text = len(part), Counter(part), 0, part[:16], part[-1:], part
        else:
            length, counts, scale, head, tail, text = part.length, part.counts, part.scale, part.head, part.tail, part.text
        if not length:
            return
        self._coarser(max(0, scale - self.scale))
        if scale < self.scale:
            length, counts = _in_units(length, counts, self.scale - scale)
        self.length += length
        self.counts.update(counts)
        self.text = self.text + text if self.scale == 0 and self.length <= KEPT else ""
        self._coarser(PRECISION if self.length >> (2 * PRECISION) else 0)
        self.head = (self.head + head)[:16]
        self.tail = tail

    def _coarser(self, bits: int) -> None:
        if bits:
            self.length, self.counts = _in_units(self.length, self.counts, bits)
            self.scale += bits

    def stands_in(self) -> bool:
        """Whether it only holds the place of a secret (longer ones: by their characters, beginning and end)."""
        if self.scale == 0 and self.length <= KEPT:
            return bool(STAND_IN.match(self.text))
        wrapped = (self.head.startswith("<") and self.tail == ">") or (self.head.startswith("${") and self.tail == "}")
        return wrapped or set(self.counts) <= set("xX") or set(self.counts) == {"*"} or self.head.lower().startswith(("your_", "your-"))


#: Characters of a value that are remembered as they are.
KEPT = 4096
#: Bits of the counts of a value of any length: twice what a double holds.
PRECISION = 128


def _in_units(length: int, counts: Counter, bits: int) -> tuple[int, Counter]:
    """Counts in units of 2 ** ``bits``, at least one where there was any."""
    return length >> bits, Counter({c: max(1, n >> bits) for c, n in counts.items()})


def literal_score(value: "str | Value") -> float:
    """How far a literal looks made by chance: bits per character and kinds of characters, 0 to 0.5."""
    value = Value(value) if isinstance(value, str) else value
    if (value.scale == 0 and value.length < 8) or " " in value.counts or value.stands_in():
        return -1.0
    bits = -sum(n / value.length * math.log2(n / value.length) for n in value.counts.values())
    used = "".join(value.counts)
    kinds = sum(bool(re.search(p, used)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(0.5, 0.08 * max(0.0, bits - 2) + 0.05 * (kinds - 1))


def pairs(text: str) -> Iterator[tuple[int, int, str, Value]]:
    """Assignments: start and end in the text, target name, and the value with names replaced by what they hold.

    Names hold values of any length, as ``Value`` keeps them; a name that stands for another one shares its value.
    """
    known: dict[str, Value] = {}
    for m in PAIR.finditer(text):
        name, at, value, shared, resolved = m[1] or m[2] or m[3], m.end(), None, False, False
        while piece := PIECE.match(text, at):
            quoted = piece[1] if piece[1] is not None else piece[2]
            held = known.get(piece[3]) if quoted is None else None
            part = quoted if quoted is not None else piece[3] if held is None else held
            if value is None and held is not None:
                value, shared = held, True
            else:
                value, shared = Value() if value is None else Value(value) if shared else value, False
                value.add(part)
            resolved = resolved or quoted is not None or held is not None
            at = piece.end()
            plus = PLUS.match(text, at)
            if not plus or not PIECE.match(text, plus.end()):
                break
            at = plus.end()
        if value is not None:
            if resolved:
                known[name] = value
            yield m.start(), at, name, value


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base kinds by start, then kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def further_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Assignments that score as secrets and overlap no base ``assign`` span, by start."""
    if "=" not in text and ":" not in text:
        return []
    found = []
    for start, end, name, value in pairs(text):
        by_name = name_score(name)
        if by_name > 0.3 and by_name + literal_score(value) >= THRESHOLD:
            found.append((start, end, "literal"))
    return clear(found, [s for s in base if s[2] == "assign"])


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


RESULT = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def find_secrets(text: str | None) -> tuple[list, list]:
    """Base spans and further spans ``(start, end, kind)`` in code points. Null is an empty text."""
    base = base_spans(text or "")
    return base, further_spans(text or "", base)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            base, further = find_secrets(text.as_py())
            counts = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
            rows.append((doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + further)))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def secrets(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts of base spans, their digest, and all spans.

    A null or empty text has none. Rows are judged by their own text alone, so repeated rows, null ids and further
    columns change nothing; one pass without a shuffle.
    """
    return docs.select("doc_id", "text").mapInArrow(_report, RESULT)
