"""Removal of repeated passages by a depth-limited radix sort of all suffixes.

Suffixes are told apart only through their first ``THRESHOLD`` bytes, by most significant digits. The first digit of
a suffix is the anchor of its leading window: the run of ``GRAM`` bytes with the smallest hash among all such runs of
the window, which every copy of the window has too. Suffixes whose anchor stands in one document only are sorted and
leave. The rest go through the second pass, whose digit is the whole window as a 64-bit digest. Groups that are equal
after it are the repeated windows; in each, all but those of the smallest document id are removed.

Documents that equal one with a smaller id leave before the first pass: all their windows are repeated, and none is
the first of its group. Equal anchors come in runs of neighbouring suffixes, so the first pass moves about one
five-byte key for every 12 bytes of text, and each block of documents sends a key once.

The digest is exact but for chance: of N windows that reach the second pass N^2 / 2^65 are expected to meet a
different one with the same digest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as tx
from ordermill.llm.blocks import Block, Corpus, answered

#: Bytes that a repeated passage has at least.
THRESHOLD = 50
#: Bytes of an anchor.
GRAM = 28
#: Suffixes that are looked at together.
CHUNK = 1 << 19


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


def document_keys(block: Block) -> np.ndarray:
    """A digest of each whole document."""
    sums = tx.prefix_sums(block.data)
    return tx.run_hashes(sums, block.offsets[:-1], block.offsets[1:])


def whole_copies(block: Block, threshold: int, buckets: int | None = None, reply: list | None = None):
    """Distinct digests of a block's documents with the smallest id of each, and which documents equal an earlier one."""
    keys = document_keys(block)
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    # first: documents are in the order of their ids
    by_id = np.argsort(first, kind="stable")
    order = block.ids[first]
    copy = block.ids > order[inverse]
    if buckets is not None:
        later = np.zeros(len(distinct), dtype=bool)
        later[by_id] = answered(distinct[by_id], buckets, reply)
        copy |= later[inverse]
    return distinct[by_id], order[by_id], copy & (block.sizes >= threshold)


class Windows:
    """The windows of a block's documents in runs that share an anchor; documents marked ``gone`` have none."""

    def __init__(self, block: Block, gone: np.ndarray, threshold: int, gram: int):
        n, self.starts, self.lengths, anchors = len(block.data), [], [], []
        valid = np.repeat(np.tile([True, False], len(block.sizes)), self._split(block.sizes, gone, threshold))
        for a in range(0, max(0, n - threshold + 1), CHUNK):
            b = min(n - threshold + 1, a + CHUNK)
            least = sliding_least(tx.rolling_hashes(block.data[a : b + threshold - 1], gram), threshold - gram + 1)
            ok = valid[a:b]
            new = ok.copy()
            new[1:] &= (least[1:] != least[:-1]) | ~ok[:-1]
            head = np.flatnonzero(new)
            end = np.append(head[1:], b - a)
            stop = np.flatnonzero(ok[:-1] & ~ok[1:]) + 1  # a run ends with its document too
            k = np.searchsorted(stop, head, side="right")
            end = np.minimum(end, np.append(stop, b - a)[k])
            self.starts.append(head + a)
            self.lengths.append(end - head)
            anchors.append(least[head])
        empty = np.empty(0, np.int64)
        self.starts, self.lengths = np.concatenate([empty, *self.starts]), np.concatenate([empty, *self.lengths])
        anchors = np.concatenate([np.empty(0, np.uint64), *anchors])
        document = np.searchsorted(block.offsets, self.starts, side="right") - 1
        order = np.argsort(anchors)
        new = np.ones(len(order), dtype=bool)
        new[1:] = anchors[order[1:]] != anchors[order[:-1]]
        head = np.flatnonzero(new)
        self.anchors = anchors[order[head]]
        own = block.ids[document[order]]
        self.shared = np.minimum.reduceat(own, head) != np.maximum.reduceat(own, head) if len(order) else np.empty(0, bool)
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1

    @staticmethod
    def _split(sizes: np.ndarray, gone: np.ndarray, threshold: int) -> np.ndarray:
        own = np.where(gone, 0, np.maximum(sizes - threshold + 1, 0))
        return np.stack([own, sizes - own], axis=1).ravel()

    def places(self, kept: np.ndarray) -> np.ndarray:
        """Where the windows begin whose anchor is marked ``kept``."""
        runs = np.flatnonzero(kept[self.number])
        n = self.lengths[runs]
        return np.repeat(self.starts[runs] - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Survivors:
    """The windows that reach the second pass: digests, and for each whether a document of the block has it earlier."""

    def __init__(self, block: Block, places: np.ndarray, threshold: int):
        self.places = places
        digests = np.empty(len(places), np.uint64)
        for a in range(0, len(block.data), CHUNK):  # sums over a chunk at a time
            i, j = np.searchsorted(places, [a, a + CHUNK])
            if j > i:
                sums = tx.prefix_sums(block.data[a : a + CHUNK + threshold])
                digests[i:j] = tx.run_hashes(sums, places[i:j] - a, places[i:j] - a + threshold)
        ids = block.ids[np.searchsorted(block.offsets, places, side="right") - 1]
        order = np.argsort(digests)
        new = np.ones(len(order), dtype=bool)
        new[1:] = digests[order[1:]] != digests[order[:-1]]
        # the first place of each group, so of the smallest id
        head = np.minimum.reduceat(order, np.flatnonzero(new)) if len(order) else order
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.later = ids > ids[head][self.group] if len(order) else np.empty(0, bool)
        self.by_place = np.argsort(head, kind="stable")
        self.digests, self.ids = digests[head][self.by_place], ids[head][self.by_place]

    def removed(self, elsewhere: np.ndarray) -> np.ndarray:
        """Where the windows begin that are to go; ``elsewhere`` answers for each digest."""
        by_group = np.zeros(len(self.digests), dtype=bool)
        by_group[self.by_place] = elsewhere
        return self.places[self.later | (by_group[self.group] if len(self.group) else self.later)]


def repeated_bytes(docs: DataFrame, finish, schema: str, name: str, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """Run ``finish(block, removed)`` on every block, ``removed`` marking the bytes to go; see ``deduplicated``."""
    corpus = Corpus(docs)
    buckets = corpus.buckets

    def first(block: Block, replies: list):
        keys, order, _ = whole_copies(block, threshold)
        return keys, order

    def second(block: Block, replies: list):
        _, _, gone = whole_copies(block, threshold, buckets, replies[0])
        return Windows(block, gone, threshold, gram).anchors, None

    def survivors(block: Block, replies: list) -> Survivors:
        _, _, gone = whole_copies(block, threshold, buckets, replies[0])
        windows = Windows(block, gone, threshold, gram)
        return Survivors(block, windows.places(windows.shared | answered(windows.anchors, buckets, replies[1])), threshold)

    def third(block: Block, replies: list):
        left = survivors(block, replies)
        return left.digests, left.ids

    def last(block: Block, replies: list) -> pa.RecordBatch:
        _, _, gone = whole_copies(block, threshold, buckets, replies[0])
        left = survivors(block, replies)
        places = left.removed(answered(left.digests, buckets, replies[2]))
        n = len(block.data) + 1
        edge = np.bincount(places, minlength=n) - np.bincount(places + threshold, minlength=n)
        removed = np.cumsum(edge[:-1]) > 0
        removed |= np.repeat(gone, block.sizes)
        return finish(block, removed)

    for question in (first, second, third):
        corpus.ask(question)
    return corpus.result(last, schema, name)


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _report(block: Block, removed: np.ndarray) -> pa.RecordBatch:
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    inner = block.offsets[:-1][block.sizes > 0]
    begins[inner] = removed[inner]
    count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[block.offsets])
    n_removed, n_spans = count(removed), count(begins)
    kept = [hashlib.sha256(block.data[a:b][~removed[a:b]].tobytes()).hexdigest() for a, b in zip(block.offsets[:-1], block.offsets[1:], strict=True)]
    values = [block.batch.column("doc_id"), pa.array(block.sizes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept)]
    return pa.RecordBatch.from_arrays(values, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def deduplicated(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its bytes, what is removed of them, and the rest's digest.

    A byte goes if a string of ``threshold`` bytes around it also starts in a document with a smaller id. Null texts
    are empty; a null id counts as larger than all others; rows of equal id never remove from each other. Empty
    tables give no rows. A text is handled whole in one task, with some 60 bytes of memory for each of its own.
    """
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return repeated_bytes(kept, _report, RESULT, "suffix-dedup", threshold)


ORACLE = f"""
with d as (
  select row_number() over () as rid, coalesce(doc_id, 9223372036854775807) as ord, doc_id, hex(encode(coalesce(text, ''))) as hx
  from documents),
windows as (
  select rid, ord, unnest(range(0, greatest(0, length(hx) // 2 - {THRESHOLD - 1}))) as i from d),
cut as (
  select w.rid, w.ord, w.i, substr(d.hx, 2 * w.i + 1, {2 * THRESHOLD}) as s from windows w join d using (rid)),
firsts as (select s, min(ord) as least from cut group by s),
later as (select rid, i from cut join firsts using (s) where ord > least),
marked as (
  select rid, i, case when i - lag(i) over (partition by rid order by i) <= {THRESHOLD} then 0 else 1 end as new from later),
grouped as (select rid, i, sum(new) over (partition by rid order by i) as span from marked),
spans as (select rid, span, min(i) as a, max(i) + {THRESHOLD} as b from grouped group by rid, span),
between_spans as (
  select s.rid, s.a, s.b, coalesce(lag(s.b) over (partition by s.rid order by s.a), 0) as before from spans s),
pieces as (
  select p.rid, count(*) as n_spans, sum(p.b - p.a) as n_removed, max(p.b) as last,
    string_agg(substr(d.hx, 2 * p.before + 1, 2 * (p.a - p.before)), '' order by p.a) as kept
  from between_spans p join d using (rid) group by p.rid)
select d.doc_id, length(d.hx) // 2 as n_bytes, coalesce(p.n_removed, 0)::bigint as n_removed,
  coalesce(p.n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(p.kept, '') || substr(d.hx, 2 * coalesce(p.last, 0) + 1))) as kept_sha256
from d left join pieces p using (rid)"""
