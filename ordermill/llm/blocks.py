"""Documents in blocks of some megabytes, and questions that all blocks put to each other.

A block is a batch of whole documents, in the order of their ids, kept as Arrow bytes in one row of a table that is
bucketed by the task that made it. Any number of passes read that table; the text never moves again.

A question is a set of 64-bit keys for each block. Keys go to buckets by their leading digit (their top bits), packed
into one row for each block and bucket, and each key once for each block: a key that a third of all documents share is
no larger for a bucket than one that stands in every block once. The bucket's answers, one bit for each key, are
joined back to the blocks, for which the small side alone is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as tx
from ordermill.llm.store import deleted, dropped, written
from ordermill.session import fresh_path

#: Bytes of text of a block. One document alone may be longer; memory for a pass is some 60 bytes for each of these.
BLOCK = 1 << 21
#: Bytes of text for each bucket of keys.
BUCKET = 1 << 23
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that a reader of Parquet decodes at once; a row of the table of blocks is a block, one of replies those of many.
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
#: How the table of blocks is cut: sizes are looked at after each row, so that row groups and pages are a few blocks,
#: however many blocks a file has. By default the writer looks after 100 rows.
FILES = {
    "parquet.block.size": str(4 * BLOCK), "parquet.page.size": str(BLOCK),
    "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
    "parquet.enable.dictionary": "false",
}
#: The order of documents without an id: after all others.
LAST = np.iinfo(np.int64).max


def unpacked(rows: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(rows).read_next_batch()


class Block:
    """Documents of a block: ``batch`` has their columns, ``ids`` their order, ``data`` their bytes."""

    def __init__(self, rows: bytes, id_column: str = "doc_id", text_column: str = "text"):
        self.batch = unpacked(rows)
        self.ids = np.array([LAST if i is None else i for i in self.batch.column(id_column).to_pylist()], dtype=np.int64)
        whole = list(tx.text_slices(self.batch, text_column, limit=1 << 62))
        _, _, self.data, self.offsets = whole[0] if whole else (0, 0, np.empty(0, np.uint8), np.zeros(1, np.int64))
        self.sizes = np.diff(self.offsets)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a key: its top bits, spread evenly over any number of buckets; grows with the key."""
    out = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return out.astype(np.uint16 if buckets <= 1 << 16 else np.int64)


def arrangement(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which a block's keys are packed, by bucket, and where each bucket begins (one entry more)."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def answered(keys: np.ndarray, buckets: int, reply: list | None) -> np.ndarray:
    """The answer to each of a block's keys, from the reply as the table of replies holds it."""
    order, edges = arrangement(keys, buckets)
    out = np.zeros(len(keys), dtype=bool)
    for part in reply or []:
        a, b = edges[part["bucket"]], edges[part["bucket"] + 1]
        out[order[a:b]] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=b - a).astype(bool)
    return out


def _pack(keys: np.ndarray, orders: np.ndarray | None) -> tuple[bytes, bytes]:
    """Bytes of a bucket's keys: five each where only their presence counts, else eight and the runs of orders."""
    if orders is None:
        return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes(), b""
    head = np.flatnonzero(np.concatenate([[True], orders[1:] != orders[:-1]]))
    return keys.astype("<u8").tobytes(), orders[head].astype("<i8").tobytes() + np.diff(np.append(head, len(orders))).astype("<i8").tobytes()


def _unpack(keys: bytes, orders: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    if not orders:
        wide = np.zeros((len(keys) // 5, 8), np.uint8)
        wide[:, :5] = np.frombuffer(keys, np.uint8).reshape(-1, 5)
        return wide.reshape(-1).view("<u8"), None
    runs = np.frombuffer(orders, "<i8")
    return np.frombuffer(keys, "<u8"), np.repeat(runs[: len(runs) // 2], runs[len(runs) // 2 :])


def _answer(group: pa.Table) -> pa.Table:
    """Bits for each packed row of a bucket: whether another block has the key, or one of smaller order has it."""
    got = [_unpack(k, o) for k, o in zip(group.column("keys").to_pylist(), group.column("orders").to_pylist(), strict=True)]
    keys = np.concatenate([k for k, _ in got])
    order = np.argsort(keys)
    new = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])
    head = np.flatnonzero(new)
    if got[0][1] is None:
        yes = np.repeat(np.diff(np.append(head, len(keys))) > 1, np.diff(np.append(head, len(keys))))
    else:
        orders = np.concatenate([o for _, o in got])[order]
        yes = orders > np.repeat(np.minimum.reduceat(orders, head), np.diff(np.append(head, len(keys))))
    flags = np.empty(len(keys), dtype=bool)
    flags[order] = yes
    edges = np.cumsum([0, *(len(k) for k, _ in got)])
    bits = [np.packbits(flags[a:b]).tobytes() if flags[a:b].any() else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table([group.column("part"), group.column("block"), group.column("bucket"), pa.array(bits, pa.binary())], names=["part", "block", "bucket", "bits"])


class Corpus:
    """The blocks of a table of documents and the replies to the questions asked so far.

    ``docs`` needs a long id and a text column; all its columns are kept. Call ``close`` when no pass is left to run.
    """

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK):
        self.spark = docs.sparkSession
        self.width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"ordermill_blocks_{uuid.uuid4().hex}"
        self.replies: list[DataFrame] = []

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, block, waiting, size = TaskContext.get().partitionId(), 0, [], 0

            def row() -> pa.RecordBatch:
                whole = pa.Table.from_batches(waiting).combine_chunks()
                whole = whole.sort_by([("doc_id", "ascending")]).combine_chunks()
                sink = pa.BufferOutputStream()
                batch = whole.to_batches()[0]
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(batch)
                names = ["part", "block", "bytes", "rows"]
                values = [pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
                return pa.RecordBatch.from_arrays(values, names=names)

            for batch in batches:
                for first, end, data, _ in tx.text_slices(batch, "text", block_bytes):
                    if waiting and size + len(data) > block_bytes:
                        yield row()
                        block, waiting, size = block + 1, [], 0
                    waiting.append(batch.slice(first, end - first))
                    size += len(data)
            if waiting:
                yield row()

        packed = docs.mapInArrow(pack, "part bigint, block bigint, bytes bigint, rows binary")
        self.path = fresh_path(self.spark, "blocks")
        writer = packed.write.format("parquet").options(compression="zstd", path=self.path, **FILES)
        with self._short_batches():
            writer.bucketBy(self.width, "part").saveAsTable(self.name)
        size = self.spark.table(self.name).agg(F.sum("bytes")).first()[0] or 0
        self.buckets = max(self.width, -(-size // BUCKET))

    def _blocks(self) -> DataFrame:
        """The blocks with the reply to each question: a list of buckets' bits, or null."""
        out = self.spark.table(self.name)
        for k, reply in enumerate(self.replies):
            own = F.filter("answers", lambda x: x["block"] == F.col("block"))
            out = out.join(reply.hint("shuffle_hash"), "part", "left").withColumn(f"reply{k}", own).drop("answers")
        return out

    def ask(self, question: Callable[[Block, list], tuple[np.ndarray, np.ndarray | None]]) -> None:
        """Put each block's keys to all others; ``question`` gets a block and the replies so far.

        It returns keys, each at most once, and either None (is the key in another block too?) or each key's order
        (does another block have it with a smaller one?), equal orders standing together.
        """
        buckets = self.buckets

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, replies, part, block in _each(batches):
                keys, orders = question(Block(rows), replies)
                order, edges = arrangement(keys, buckets)
                out = []
                for bucket in np.flatnonzero(np.diff(edges)).tolist():
                    own = order[edges[bucket] : edges[bucket + 1]]
                    out.append((bucket, *_pack(keys[own], None if orders is None else orders[own])))
                if out:
                    b, k, o = zip(*out, strict=True)
                    values = [pa.array(b, pa.int64()), pa.array([part] * len(b), pa.int64()), pa.array([block] * len(b), pa.int64()), pa.array(k, pa.binary()), pa.array(o, pa.binary())]
                    yield pa.RecordBatch.from_arrays(values, names=["bucket", "part", "block", "keys", "orders"])

        sent = self._blocks().mapInArrow(send, "bucket bigint, part bigint, block bigint, keys binary, orders binary")
        told = sent.groupBy("bucket").applyInArrow(_answer, "part bigint, block bigint, bucket bigint, bits binary")
        told = told.where("bits is not null").groupBy("part").agg(F.collect_list(F.struct("block", "bucket", "bits")).alias("answers"))
        with self._short_batches():
            self.replies.append(written(told, "replies"))

    def result(self, finish: Callable[[Block, list], pa.RecordBatch], schema: str, name: str) -> DataFrame:
        """One last pass over the blocks with all replies, written to the shared folder; then the blocks go."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, replies, _, _ in _each(batches):
                yield finish(Block(rows), replies)

        with self._short_batches():
            out = written(self._blocks().mapInArrow(run, schema), name, keep=True)
        self.close()
        return out

    @contextmanager
    def _short_batches(self):
        """Meanwhile Arrow and Parquet batches hold a few blocks only, as Python and the executor both keep a copy of one."""
        wanted = {BATCH: str(4 * BLOCK), READ_ROWS: "4"}
        before = {name: self.spark.conf.get(name) for name in wanted}
        for name, value in wanted.items():
            self.spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        deleted(self.spark, self.path)
        for reply in self.replies:
            dropped(reply)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list, int, int]]:
    for batch in batches:
        names = [n for n in batch.schema.names if n.startswith("reply")]
        for k in range(batch.num_rows):
            cell = lambda name, k=k: batch.column(name)[k].as_py()
            yield batch.column("rows")[k].as_buffer(), [cell(n) for n in names], cell("part"), cell("block")
