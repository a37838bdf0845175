"""What the messages that streams read take on disk, and a micro-batch of them in memory."""

import os

from tests.helpers import rows

from checks import flow, warehouse
from ordermill.session import fresh_path
from ordermill.streaming import orders as stream


def size(path):
    return sum(os.path.getsize(f"{at}/{name}") for at, _, names in os.walk(path) for name in names)


def files(path):
    return sorted(name for name in os.listdir(path) if name.startswith("part-"))


def kept(spark):
    """Folders of intermediate tables by name."""
    at = f"{spark.conf.get('spark.checkpoint.dir')}/ordermill"
    return {f"{at}/{name}" for name in os.listdir(at)} if os.path.isdir(at) else set()


def batches(path):
    return {name for name in os.listdir(path) if name.startswith("batch_id=")}


def test_messages_are_small_bounded_files_of_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "MESSAGES_A_FILE", 300)
    payloads = spark.range(1000).selectExpr("concat('{\"InvoiceNo\": \"', id, '\", \"Quantity\": \"1\", \"UnitPrice\": \"1.5\"}') as value").coalesce(1)
    path, plain = fresh_path(spark, "bounded"), fresh_path(spark, "plain")
    warehouse.write_messages(payloads, path)
    payloads.write.text(plain)
    assert len(files(path)) == 4 and size(path) * 2 < size(plain)
    assert rows(spark.read.text(path)) == rows(payloads)
    assert stream.parse_orders(spark.read.text(path)).count() == 1000


def test_dead_letters_keep_their_messages_once_and_in_batches(spark, small, monkeypatch):
    monkeypatch.setattr(warehouse, "MESSAGES_A_FILE", 500)
    before = kept(spark)
    whole = rows(flow.stream_dead_letter_reasons(spark, small))
    new = kept(spark) - before
    plain = spark.read.text([p for p in new if "foreign-messages" in p])
    lengths = sum(len(r["value"]) + 1 for r in plain.collect())
    assert sum(size(f"{p}/in") for p in new if os.path.isdir(f"{p}/in")) == 0  # no second copy
    assert sum(size(p) for p in new if "foreign-messages" in p) * 2 < lengths
    [sinks] = [p for p in new if "/sinks-" in p]
    assert len(batches(f"{sinks}/orders")) >= 1
    monkeypatch.setattr(flow, "FILES_A_BATCH", 2)
    before = kept(spark)
    assert rows(flow.stream_dead_letter_reasons(spark, small)) == whole
    [sinks] = [p for p in kept(spark) - before if "/sinks-" in p]
    assert len(batches(f"{sinks}/orders")) > 1


def test_years_of_messages_come_in_compressed_files_in_their_order(spark, small):
    before = kept(spark)
    path = flow.yearly_messages(spark, small)
    text = spark.read.text(path)
    years = sorted({r["y"] for r in text.selectExpr("substr(get_json_object(value, '$.InvoiceDate'), 1, 4) as y").collect() if r["y"]})
    assert len(files(path)) == flow.FILES_A_YEAR * len(years)
    assert size(path) * 2 < sum(len(r["value"]) + 1 for r in text.collect())
    assert rows(text) == rows(warehouse.order_messages(flow.raw(spark, small)))
    assert kept(spark) - before == {path, f"{path}-dated"}
    assert all(name.endswith("zstd.parquet") for _, _, names in os.walk(f"{path}-dated") for name in names if name.startswith("part-"))


def test_a_scored_stream_keeps_a_bounded_batch(spark, small, monkeypatch):
    monkeypatch.setattr(warehouse, "MESSAGES_A_FILE", 500)
    whole = rows(flow.stream_revenue_only(spark, small))
    monkeypatch.setattr(flow, "FILES_A_BATCH", 2)
    before = kept(spark)
    assert rows(flow.stream_revenue_only(spark, small)) == whole
    new = kept(spark) - before
    [scores] = [p for p in new if "/scores-" in p]
    assert len(batches(f"{scores}/scores")) > 1 and len(batches(f"{scores}/alerts")) > 1
    [written] = [p for p in new if "/messages-" in p]
    assert size(written) * 2 < sum(len(r["value"]) + 1 for r in spark.read.text(written).collect())
