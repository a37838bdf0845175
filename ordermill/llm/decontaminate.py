"""Benchmark decontamination by suffix arrays over the training texts.

Every task builds, shard by shard (some megabytes of its texts), the sorted array of the shard's word suffixes and
finds in it, by binary search, every suffix of the benchmark items. The two ends of the search enclose all places
where an item's window occurs; places that follow each other on a diagonal make the longest verbatim match.

Only suffixes whose first words begin somewhere in the benchmark enter the array, as no other can match. The
benchmark's word hashes go to every task; a benchmark of more than ``PART_WORDS`` words is searched for in parts, one
after the other, with what was hit kept in a written table between them. Texts are never shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as tx
from ordermill.llm.store import written

#: Words of a window. An item with fewer is one window.
WINDOW = 13
#: Words by which a suffix is let into the array, at most.
LEAD = 5
#: Words of benchmark text searched for at once: eight bytes each are sent to every task.
PART_WORDS = 4_000_000
#: Documents with this share of hit words are contaminated: n_hit / n_words >= 1 / SHARE.
SHARE = 20


class Tests:
    """All suffixes of some benchmark items that can begin a window, ready to be searched for."""

    def __init__(self, ids: list[str], sequences: list[np.ndarray]):
        self.ids = ids
        at, item, size = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        base = 0
        for k, seq in enumerate(sequences):
            window = min(WINDOW, len(seq))
            n = len(seq) - window + 1 if window else 0
            at.append(base + np.arange(n))
            item.append(np.full(n, k))
            size.append(np.full(n, window))
            base += len(seq)
        self.at, self.item, self.size = np.concatenate(at), np.concatenate(item), np.concatenate(size)
        words = np.concatenate([*sequences, np.zeros(WINDOW, np.uint64)])
        self.lead = int(min(LEAD, self.size.min())) if len(self.size) else 0
        places = self.at[:, None] + np.arange(WINDOW)
        inside = np.arange(WINDOW) < self.size[:, None]
        self.low = keys(np.where(inside, words[places], np.uint64(0)))
        self.high = keys(np.where(inside, words[places], np.uint64(2**64 - 1)))
        self.leads = np.unique(tx.grams(words, self.lead)[self.at]) if self.lead else np.empty(0, np.uint64)
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(self.leads & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.at)


def keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word hashes as byte strings that sort like the rows."""
    return np.ascontiguousarray(rows.astype(">u8")).view(f"S{8 * rows.shape[1]}").ravel()


def suffix_array(hashes: np.ndarray, first: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Places of a shard's suffixes in sorted order, and the leading ``WINDOW`` words of each as a key.

    ``first`` holds where each text's words begin; a suffix ends with its text.
    """
    grams = tx.grams(hashes, tests.lead)
    maybe = np.flatnonzero(tests.bits[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
    found = np.searchsorted(tests.leads, grams[maybe])
    places = maybe[tests.leads[np.minimum(found, len(tests.leads) - 1)] == grams[maybe]]
    end = first[np.searchsorted(first, places, side="right")]
    reach = places[:, None] + np.arange(WINDOW)
    words = np.where(reach < end[:, None], hashes[np.minimum(reach, len(hashes) - 1)], np.uint64(0))
    sort = keys(words)
    order = np.argsort(sort, kind="stable")
    return places[order], sort[order]


def matches(hashes: np.ndarray, first: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a place in the shard and an item's window (its number among the tests) that begins there."""
    nothing = np.empty(0, np.int64)
    if not len(tests) or len(hashes) < tests.lead:
        return nothing, nothing
    places, sort = suffix_array(hashes, first, tests)
    if not len(places):
        return nothing, nothing
    low = np.searchsorted(sort, tests.low, side="left")
    high = np.searchsorted(sort, tests.high, side="right")
    n = high - low
    test = np.repeat(np.arange(len(tests)), n)
    return places[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)], test


def longest_runs(at: np.ndarray, test: np.ndarray, text: np.ndarray, tests: Tests, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the words of the longest verbatim match and the word it begins at in the shard (or -1)."""
    length, place = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    if not len(at):
        return length, place
    item, diagonal = tests.item[test], at - tests.at[test]
    order = np.lexsort((at, diagonal, item, text))
    a, t, i, d = at[order], text[order], item[order], diagonal[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1] + 1) | (t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (d[1:] != d[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(a))) + tests.size[test[order]][head] - 1
    for k in np.lexsort((-a[head], size)):
        length[t[head[k]]], place[t[head[k]]] = size[k], a[head[k]]
    return length, place


def marked(hashes: np.ndarray, first: np.ndarray, tests: Tests) -> tuple[np.ndarray, list[list[str]], np.ndarray, np.ndarray]:
    """For a shard: whether each word is hit; for each text the items found, longest match and where it begins."""
    n = len(first) - 1
    at, test = matches(hashes, first, tests)
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + tests.size[test], -1)
    text = np.searchsorted(first, at, side="right") - 1
    items: list[list[str]] = [[] for _ in range(n)]
    for pair in np.unique(text * max(1, len(tests.ids)) + tests.item[test]):
        k, item = divmod(int(pair), len(tests.ids))
        items[k].append(tests.ids[item])
    length, place = longest_runs(at, test, text, tests, n)
    return np.cumsum(edge[:-1]) > 0, items, length, place - first[:-1]


STATE = "n_words bigint, n_hit bigint, hits binary, items array<string>, longest_match bigint, longest_at bigint"


def searched(docs: DataFrame, benchmark: DataFrame, kept: list[str], part_words: int = PART_WORDS) -> DataFrame:
    """Columns ``kept`` of ``docs`` in a struct ``row``, and what was found: n_words, n_hit, hits, items,
    longest_match, longest_at.

    ``hits`` has a bit for each word. One pass over the texts for each part of the benchmark.
    """
    spark = docs.sparkSession
    state = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "text")
    parts = benchmark_parts(benchmark, part_words)
    for k, part in enumerate(parts):
        sent = spark.sparkContext.broadcast(part())
        last = k == len(parts) - 1
        row = state.schema["row"].dataType.simpleString()
        schema = f"row {row}, " + ("" if last else "text string, ") + STATE
        state = state.mapInArrow(_search(sent, last), schema)
        state = state if last else written(state, "decontamination")
    return state


def benchmark_parts(benchmark: DataFrame, part_words: int):
    """One function for each part; calling it collects that part alone."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), "text")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / 5 / part_words))

    def part(k: int) -> Tests:
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        rows.sort(key=lambda r: (r["id"], r["text"] or ""))
        sequences = []
        for r in rows:
            data = np.frombuffer((r["text"] or "").encode(), dtype=np.uint8)
            sequences.append(tx.words(data, np.array([0, len(data)]), tx.LETTERS)[0])
        return Tests([r["id"] for r in rows], sequences)

    return [lambda k=k: part(k) for k in range(n)]


def _search(sent, last: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = sent.value
        for batch in batches:
            before = batch.schema.get_field_index("hits") >= 0
            for row, end, data, offsets in tx.text_slices(batch, "text"):
                part = batch.slice(row, end - row)
                hashes, first = tx.words(data, offsets, tx.LETTERS)
                hit, items, length, place = marked(hashes, first, tests)
                n = np.diff(first)
                hits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                length, place = length.tolist(), place.tolist()
                if before:
                    for k, (bits, found, size, at) in enumerate(
                        zip(*[part.column(c).to_pylist() for c in ("hits", "items", "longest_match", "longest_at")], strict=True)
                    ):
                        hits[k] = (np.frombuffer(hits[k], np.uint8) | np.frombuffer(bits, np.uint8)).tobytes()
                        items[k] = items[k] + found
                        if (size, -at) > (length[k], -place[k]):
                            length[k], place[k] = size, at
                columns = {"row": part.column("row")} | ({} if last else {"text": part.column("text")})
                n_hit = [int(np.unpackbits(np.frombuffer(bits, np.uint8)).sum()) for bits in hits]
                columns |= {"n_words": pa.array(n, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()), "hits": pa.array(hits, pa.binary())}
                columns |= {"items": pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))}
                columns |= {"longest_match": pa.array(length, pa.int64())}
                columns |= {"longest_at": pa.array([a if m else -1 for m, a in zip(length, place, strict=True)], pa.int64())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return search


def decontamination(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """One row for each row of ``docs``: its words, hit words, items found, their digest, and whether it is contaminated.

    A null or empty text has no words, is hit by nothing and isn't contaminated. Items without words have no window;
    an item with a null id goes by the name ``null``; items of equal id count once. Repeated documents are judged each
    by itself. ``longest_match`` and ``longest_at`` tell the longest verbatim match in words and the word it begins at
    (0 and -1 without one).
    """
    found = searched(docs, benchmark, ["doc_id"], part_words)
    return found.select("row.doc_id", *_report_columns())


def _report_columns() -> list:
    return [
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "longest_match",
        "longest_at",
    ]


def without_contaminated(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with all their columns. A null text stays."""
    found = searched(docs, benchmark, docs.columns, part_words)
    return found.where(~((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))).select("row.*")
