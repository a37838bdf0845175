"""Streams: parsing, late rows, restarts and carried state."""

import json
from datetime import timedelta

from tests.helpers import rows
from pyspark.sql import functions as F
from test_scale import as_frame, lifecycle, replay

from ordermill.session import fresh_path
from ordermill.streaming import flow, orders

FIVE = [(2, 19.99, 39.98), (3, 15.99, 47.97), (7, 6.5, 45.5), (1, 45.5, 45.5), (5, 8.99, 44.95), (1, 125.0, 125.0)]


def payload(invoice, quantity, price, date="2024-01-01T10:00:00"):
    return json.dumps({"InvoiceNo": invoice, "Quantity": quantity, "UnitPrice": price, "InvoiceDate": date})


def test_alerts_of_known_orders(spark):
    messages = spark.createDataFrame([(payload(str(i), q, p),) for i, (q, p, _) in enumerate(FIVE)], "value string")
    priced = orders.stream_revenue(orders.parse_orders(messages))
    assert [float(r["Revenue"]) for r in priced.collect()] == [r for _, _, r in FIVE]
    assert orders.high_value_alerts(priced).count() == 1


def test_bad_payloads_are_kept_apart(spark):
    good = payload("1", 1, 2.0)
    messages = spark.createDataFrame([(good,), (good[:10],), ("hello",), ("",), (None,)], "value string")
    assert rows(orders.parse_orders(messages), "InvoiceNo") == [("1",)]
    assert orders.dead_letters(messages).count() == 4


def test_stream_equals_batch_over_a_restart(spark):
    """Two runs on one checkpoint read every message once."""
    path = fresh_path(spark, "restart")
    for run in range(2):
        batch = [(payload(f"{run}-{i}", i, 3.0),) for i in range(20)]
        spark.createDataFrame(batch, "value string").write.mode("append").text(f"{path}/in")
        stream = orders.stream_clean(orders.parse_orders(orders.read_order_stream(spark, f"{path}/in")))
        orders.write_batches(stream, {"clean": lambda b: b}, f"{path}/out").awaitTermination()
    got = spark.read.parquet(f"{path}/out/clean")
    assert got.count() == 38 and got.select("InvoiceNo").distinct().count() == 38
    assert got.select("batch_id").distinct().count() == 2


def test_late_rows_are_dropped_past_the_watermark(spark):
    path = fresh_path(spark, "late")
    for name, dates in enumerate([["10:00:00", "12:30:00"], ["10:05:00", "12:45:00"], ["12:50:00"]]):
        lines = [(payload("1", 1, 10.0, f"2024-01-01T{d}"),) for d in dates]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(f"{path}/in")
        read = orders.stream_revenue(orders.parse_orders(orders.read_order_stream(spark, f"{path}/in")))
        windows = orders.windowed_revenue(read, lateness="10 minutes")
        orders.write_batches(windows, {"windows": lambda b: b}, f"{path}/out", "update").awaitTermination()
    got = orders.latest_rows(spark.read.parquet(f"{path}/out/windows"), ["window_start"])
    assert rows(got.select(F.hour("window_start"), "orders")) == [(10, 1), (12, 3)]


def test_open_orders_carry_over_batches(spark):
    events = sorted(lifecycle(1200), key=lambda e: (e[2], e[3]))
    still, done = replay(events)
    path = fresh_path(spark, "carry")
    schema = "order_id string, kind string, seq bigint, ts timestamp"
    for part in range(3):
        df = as_frame(spark, events[part * 400 : part * 400 + 400])
        df.select("order_id", "kind", "seq", "ts").write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(schema).parquet(f"{path}/in")
        flow.order_flow(source, f"{path}/flow").awaitTermination()
    completed = spark.read.parquet(f"{path}/flow/completed")
    got = completed.select("order_id", F.unix_seconds("arrival_time"), F.unix_seconds("completion_time"))
    assert rows(got) == sorted(done, key=repr)
    left = flow.last_open(spark, f"{path}/flow").select("order_id", F.unix_seconds("arrival_time"))
    assert rows(left) == sorted(still.items(), key=repr)


def test_orders_that_never_complete_expire(spark):
    """An order is given up when the watermark passes its time, unless it went on; its state goes."""
    day = 86400
    path = fresh_path(spark, "expire")
    parts = [
        [("old", "arrive", 0, 1), ("again", "arrive", 0, 2), ("done", "arrive", 0, 3)],
        [("again", "arrive", 5 * day, 4), ("done", "complete", 6 * day, 5)],
        [("new", "arrive", 9 * day, 6)],
        [("other", "arrive", 9 * day + 1, 7)],
    ]
    for events in parts:
        later = [(order, kind, t + 100 * day, seq) for order, kind, t, seq in events]
        as_frame(spark, later).select("order_id", "kind", "seq", "ts").write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema("order_id string, kind string, seq bigint, ts timestamp").parquet(f"{path}/in")
        flow.order_flow(source, f"{path}/flow", give_up=timedelta(days=7)).awaitTermination()
    assert rows(flow.last_open(spark, f"{path}/flow"), "order_id") == [("again",), ("new",), ("other",)]
    assert rows(spark.read.parquet(f"{path}/flow/expired"), "order_id") == [("old",)]
    assert rows(spark.read.parquet(f"{path}/flow/completed"), "order_id") == [("done",)]


def test_windows_leave_the_state(spark):
    """Of ten hours in as many batches, the state holds only the windows the watermark hasn't passed."""
    path = fresh_path(spark, "evict")
    for hour in range(10):
        lines = [(payload("1", 1, 10.0, f"2024-01-01T{hour:02d}:{m:02d}:00"),) for m in (0, 30)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(f"{path}/in")
    read = orders.stream_revenue(orders.parse_orders(orders.read_order_stream(spark, f"{path}/in", files_per_batch=1)))
    query = orders.write_batches(orders.windowed_revenue(read), {"windows": lambda b: b}, f"{path}/out", "update")
    query.awaitTermination()
    left = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert left[-1] <= 2
    assert orders.latest_rows(spark.read.parquet(f"{path}/out/windows"), ["window_start"]).count() == 10


def test_messages_are_parsed_and_typed_once(spark):
    messages = spark.createDataFrame([('{"InvoiceNo": "1", "Quantity": "2", "UnitPrice": "0.5", "InvoiceDate": "1/2/2024 3:04"}',), ("x",), (None,)], "value string")
    parsed = spark.createDataFrame(messages.collect(), "value string").rdd.toDF("value string")
    for out in (orders.parse_orders(parsed), orders.stream_revenue(orders.stream_clean(orders.parse_orders(parsed)))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
        assert plan.count("M/d/yyyy H:mm:ss") == 1
    assert [(r["InvoiceNo"], r["Quantity"], str(r["InvoiceDate"])) for r in orders.parse_orders(parsed).collect()] == [("1", 2, "2024-01-02 03:04:00")]
    assert orders.dead_letters(parsed).count() == 2
