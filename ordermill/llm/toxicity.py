"""Toxicity score: a weighted lexicon, learned from labels, matched by an Aho-Corasick automaton on folded text.

Folding undoes disguises: accents, look-alike letters of other alphabets, full-width forms, invisible characters, and
digits or signs that stand for letters inside a word. Terms and texts are folded alike. A hit counts between word
boundaries unless it lies within an exception phrase; the weights of a text's hits are divided by its length, and a
logistic curve with two numbers, fitted to the labelled rows, turns that into the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.store import scratch, written

#: Most labelled rows that are learned from, picked by a hash of the id. The lexicon is bounded by their words alone.
LABELLED_ROWS = 20_000
#: A term must be in so many toxic rows, and so many times likelier there.
LEAST_ROWS, LEAST_ODDS = 3, 8.0
#: Words without any bearing on the label that are expected to come into the lexicon by chance.
BY_CHANCE = 1.0
#: Words added to each text's length, so that one hit in a very short text isn't all.
LENGTH_PRIOR = 20
#: Phrases in which a lexicon term says nothing bad, for callers that want to give some; others are learned.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy")

# Letters of other alphabets that look like Latin ones, and signs used in place of letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d",
    "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "ԛ": "q", "ԝ": "w", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ɑ": "a", "ɡ": "g", "ɩ": "i",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
INVISIBLE = ("​", "‌", "‍", "⁠", "﻿", "­")

_LETTERS = {ord(k): v for k, v in HOMOGLYPHS.items()} | dict.fromkeys(map(ord, INVISIBLE)) | {ord("l"): "i"}
_LETTERS |= dict.fromkeys(range(0x300, 0x370))
_SIGN = re.compile(r"(?<![0-9@$!|])[013457@$!|8]+(?=[^\W\d_])")
_SIGNS = {ord(k): v for k, v in SIGNS.items()}
WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case without accents, look-alikes or signs for letters; ``l`` and ``i`` count as one letter."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower()
    text = text.translate(_LETTERS)
    return _SIGN.sub(lambda m: m.group().translate(_SIGNS), text) if any(c in text for c in SIGNS) else text


@dataclass(frozen=True)
class Model:
    """What is learned: weights of folded terms, exception phrases, and the logistic curve (unfitted, no hit is harmless)."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float = 1.0
    middle: float = 1.0


def matcher(model: Model) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for term, weight in model.weights.items():
        out.add_word(term, (len(term), weight))
    for phrase in model.exceptions:
        out.add_word(phrase, (len(phrase), 0.0))
    if len(out):
        out.make_automaton()
    return out


def weight_of(text: str | None, terms: ahocorasick.Automaton) -> float:
    """Weights of the hits that count, per 100 words of the text, on a logarithmic scale."""
    text = fold(text or "")
    if not len(terms):
        return 0.0
    total, last_end, open_hits = 0.0, 0, []
    for last, (length, weight) in terms.iter(text):
        start, end = last + 1 - length, last + 1
        if (start and text[start - 1].isalpha()) or (end < len(text) and text[end].isalpha()):
            continue
        if weight == 0.0:
            last_end = max(last_end, end)
            while open_hits and open_hits[-1][0] >= start:
                total -= open_hits.pop()[1]
        elif start >= last_end or weight == 0.0:
            total += weight
            open_hits = [*open_hits[-3:], (start, weight)]
    return math.log1p(100 * max(0.0, total) / (len(text.split()) + LENGTH_PRIOR))


def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each folded word of each text once, with the text's label."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            found, labels = [], []
            part = batch.slice(at, 500)
            for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                own = {w for w in WORD.findall(fold(text or "")) if len(w) >= 2}
                found.extend(own)
                labels.extend([label] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(labels, pa.int32())], names=["word", "toxic"])


def held_out(doc_id):
    """Whether a row's label may not be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, exceptions=()) -> Model:
    """Fit the lexicon and the curve to at most ``rows`` labelled texts, none of them held out.

    Ids without a label, labels without a text, and null ids or labels are left out; an id labelled more than once
    is toxic if any of its labels says so. Without labels of both kinds the lexicon is empty. ``exceptions`` are phrases
    besides those that the clean rows tell, see ``clean_phrases``.
    """
    picked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # at most ``rows`` pairs of an id and a label, so this side may be sent to every task
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")
    with scratch(docs.sparkSession):
        return _fitted(written(texts, "labelled-texts"), exceptions)


def evidence_needed(words: dict[int, int], share: float) -> float:
    """Evidence from which words are so telling that ``BY_CHANCE`` of those tried are expected to be so by chance.

    ``words`` has the number of words for each number of rows that have the word, and ``share`` is that of toxic rows.
    Words in so few rows that even toxic ones alone wouldn't do aren't tried and don't count (Tarone's correction).
    """
    least, tried = 1, sum(words.values())
    while tried * share**least > BY_CHANCE:
        tried -= words.get(least, 0)
        least += 1
    return math.log(max(1.0, tried / BY_CHANCE))


def least_log_odds(bad: int, good: int, needed: float) -> float:
    """The least log-odds of a word's rows to be toxic against which ``bad`` and ``good`` are no more evidence than ``needed``.

    Evidence is the Chernoff bound: rows that are toxic with a chance of p have ``bad`` or more toxic ones with a chance
    of at most exp(-evidence).
    """
    rows, low, high = bad + good, 0.0, bad / (bad + good)
    for _ in range(100):
        p = (low + high) / 2
        evidence = bad * math.log(bad / (rows * p)) + (good * math.log(good / (rows * (1 - p))) if good else 0.0)
        low, high = (p, high) if evidence > needed else (low, p)
    return math.log(low / (1 - low))


def _fitted(texts: DataFrame, exceptions) -> Model:
    """The model of a stored table of labelled texts."""
    counts = texts.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in counts}
    if not n.get(0) or not n.get(1):
        return Model({}, ())
    likelier = ((F.col("bad") + 0.5) / (n[1] + 1)) / ((F.col("good") + 0.5) / (n[0] + 1))
    counts = texts.mapInArrow(distinct_words, "word string, toxic int").groupBy("word")
    counts = written(counts.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "word-counts")
    share = n[1] / (n[0] + n[1])
    sizes = counts.groupBy((F.col("bad") + F.col("good")).alias("rows")).count().collect()
    needed = evidence_needed({r["rows"]: r["count"] for r in sizes}, share)
    part = lambda own, p: F.when(F.col(own) > 0, F.col(own) * F.log(F.col(own) / ((F.col("bad") + F.col("good")) * p))).otherwise(0.0)
    lexicon = (
        counts.where(F.col("bad") >= LEAST_ROWS)
        .where(likelier >= LEAST_ODDS)
        .withColumn("evidence", part("bad", share) + part("good", 1 - share))
        .where(F.col("evidence") > needed)
        .collect()
    )
    # a term's weight is the logarithm of how many times likelier it is in toxic rows at least
    weights = {r["word"]: least_log_odds(r["bad"], r["good"], needed) - math.log(n[1] / n[0]) for r in lexicon}
    odds = {r["word"]: r["bad"] / (r["bad"] + r["good"]) for r in lexicon}
    model = Model(weights, tuple(sorted({fold(e) for e in exceptions} | clean_phrases(texts, odds, needed))))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = matcher(model)
        for batch in batches:
            values = [weight_of(t.as_py(), terms) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), batch.column("toxic")], names=["x", "toxic"])

    pairs = texts.mapInArrow(rate, "x double, toxic int").groupBy(F.round("x", 3).alias("x"), "toxic").count().collect()
    x, y, m = (np.array([float(r[k]) for r in pairs]) for k in ("x", "toxic", "count"))
    slope, middle = logistic(x, y, m)
    return Model(weights, model.exceptions, slope, middle)


def clean_phrases(texts: DataFrame, odds: dict[str, float], needed: float) -> set[str]:
    """Phrases of a lexicon term and the word before or after it that clean rows alone have, too often for chance.

    ``odds`` is the share of each term's rows that are toxic. That all of n rows with one of its phrases are clean has a
    chance of (1 - share)^n; it must be beyond the evidence that was asked of the terms.
    """

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, terms, labels = [], [], []
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                own, folded = set(), fold(text.as_py() or "")
                spans = [(m.start(), m.end()) for m in WORD.finditer(folded)]
                for k, (start, end) in enumerate(spans):
                    if folded[start:end] in odds:
                        for a, b in ((spans[k - 1][0] if k else start, end), (start, spans[k + 1][1] if k + 1 < len(spans) else end)):
                            if b - a > end - start:
                                own.add((folded[a:b], folded[start:end]))
                found += [phrase for phrase, _ in own]
                terms += [term for _, term in own]
                labels += [label] * len(own)
            columns = [pa.array(found, pa.string()), pa.array(terms, pa.string()), pa.array(labels, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["phrase", "term", "toxic"])

    if not odds:
        return set()
    seen = texts.mapInArrow(phrases, "phrase string, term string, toxic int").groupBy("phrase", "term")
    clean = seen.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("rows")).where("bad = 0 and rows >= 3").collect()
    return {r["phrase"] for r in clean if -r["rows"] * math.log1p(-min(odds[r["term"]], 1 - 1e-9)) > needed}


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the curve that fits the labels best, by Newton's method with a weak pull to 0."""
    order = np.lexsort((y, x))
    x, y, n = x[order], y[order], n[order]
    scale = float(np.std(x)) or 1.0
    design = np.stack([np.ones_like(x), x / scale], axis=1)
    beta, pull = np.zeros(2), np.diag([1e-6, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + pull, design.T @ (n * (y - p)) - pull @ beta)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(float(beta[1]) / scale, 1e-9)
    return slope, -float(beta[0]) / slope


RESULT = "doc_id bigint, score double"


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row of ``docs``; the text alone counts. Null and empty texts score as having no hits."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = matcher(model)
        for batch in batches:
            x = np.array([weight_of(t.as_py(), terms) for t in batch.column("text")], dtype=float)
            value = 1 / (1 + np.exp(-np.clip(model.slope * (x - model.middle), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(value)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(rate, RESULT)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """One row for each row of ``docs``: whether its label was held out, its score, and 1 where that is 0.5 or more.

    One pass over the texts picks the labelled ones, which the model is learned from, and one scores all; neither
    shuffles a text. Null, empty and wordless texts score as having no hits, very long ones as a whole, by their hits
    per words. Repeated rows get equal scores, and so do equal texts; a null id counts as not held out or held out by
    the empty string's checksum. An empty table gives no rows; other columns aren't looked at.
    """
    scored = scores(docs, learn(docs, labels, rows))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns.

    Each row is judged by its text alone: repeated rows go or stay together, null and empty texts stay unless having no
    hit already scores 0.5. Very long texts are scored whole. An empty table stays one; columns may have any names.
    """
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = matcher(model)
        for batch in batches:
            x = [weight_of(t.as_py(), terms) for t in batch.column("text")]
            good = [1 / (1 + math.exp(-min(30.0, max(-30.0, model.slope * (v - model.middle))))) < 0.5 for v in x]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, schema)
