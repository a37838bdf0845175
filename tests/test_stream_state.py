"""Streams whose state must shrink, go on after a stop, and give each row once."""

import datetime as dt
import json
import random
from datetime import timedelta

import pytest
from tests.helpers import rows

from ordermill.operators import flow as batch_flow
from ordermill.session import fresh_path
from ordermill.streaming import alerts, flow, orders

DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def files(spark, frames, schema):
    """A folder with one file for each frame, written one after the other."""
    path = fresh_path(spark, "frames")
    for frame in frames:
        spark.createDataFrame(frame, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


EVENTS = "order_id string, kind string, ts timestamp, seq bigint"


def hours_of_orders(hours=8, each=20):
    """An arrival every three minutes; all but every tenth completes after eleven, maybe in the hour after. A frame an hour."""
    frames = [[] for _ in range(hours + 1)]
    for i in range(hours * each):
        events = [(str(i), "arrive", 3 * i, 2 * i)] + [(str(i), "complete", 3 * i + 11, 2 * i + 1)] * (i % 10 > 0)
        for order, kind, minute, seq in events:
            frames[minute // 60].append((order, kind, at(minute), seq))
    return [f for f in frames if f]


def test_joined_arrivals_leave_the_state(spark):
    path = fresh_path(spark, "joined")
    frames = hours_of_orders()
    query = orders.append_to(flow.joined_flow(files(spark, frames, EVENTS)), f"{path}/rows", f"{path}/checkpoint")
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in map(dict, (json.loads(p.json) for p in query.recentProgress)) if p["stateOperators"]]
    assert len(kept) >= 8 and max(kept) < 160 and kept[-1] <= max(kept)
    got = spark.read.parquet(f"{path}/rows")
    done = [e for frame in frames for e in frame if e[1] == "complete"]
    assert got.where("completion_time is not null").count() == len(done)
    # an arrival without completion comes out an hour later, once
    last = max(e[2] for frame in frames for e in frame if e[1] == "arrive")
    lost = [e for frame in frames for e in frame if e[1] == "arrive" and int(e[0]) % 10 == 0]
    due = sorted(e[0] for e in lost if e[2] + timedelta(hours=1) < last - timedelta(minutes=10))
    assert sorted(r["order_id"] for r in got.where("completion_time is null").collect()) == due


def test_law_on_a_stream_of_many_batches_equals_the_batch_form(spark):
    path = fresh_path(spark, "law")
    frames = hours_of_orders()
    flow.law_on_stream(files(spark, frames, EVENTS), path).awaitTermination()
    got = rows(spark.read.parquet(f"{path}/windows").drop("batch_id"))
    whole = batch_flow.law_windows(spark.createDataFrame([e for f in frames for e in f], EVENTS))
    newest = max(e[2] for f in frames for e in f)
    want = [r for r in rows(whole) if r[1] <= newest - timedelta(minutes=10)]
    assert got == want and len(got) >= 7 and got[-1][2] > got[0][2] > 0
    assert spark.read.parquet(f"{path}/windows").select("batch_id").distinct().count() > 2


def test_sessions_merge_across_batches(spark):
    path = fresh_path(spark, "sessions")
    schema = "CustomerID bigint, InvoiceDate timestamp, Revenue decimal(10,2)"
    frames = [[(1, at(0), 1), (1, at(50), 2), (2, at(0), 5)], [(1, at(45), 4), (1, at(25), 8)], [(2, at(300), 1)], [(2, at(301), 1)]]
    from decimal import Decimal

    frames = [[(c, t, Decimal(r)) for c, t, r in f] for f in frames]
    stream = orders.session_revenue(files(spark, frames, schema), lateness="2 hours")
    orders.append_to(stream, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    got = rows(spark.read.parquet(f"{path}/rows"), "CustomerID", "session_start", "session_end", "orders")
    assert got == [(1, at(0), at(80), 4), (2, at(0), at(30), 1)]


def test_alerts_survive_a_restart_and_replays(spark):
    path = fresh_path(spark, "levels")
    schema = "reading_id bigint, ts timestamp, metric string, value double"
    batches = [[(1, at(0), "cpu", 10.0), (2, at(1), "cpu", 90.0)], [(2, at(1), "cpu", 90.0), (3, at(2), "cpu", 91.0)], [(4, at(3), "cpu", 99.0), (5, at(4), "cpu", 1.0)]]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{path}/in")
        with flow.on_rocksdb(spark):
            orders.append_to(alerts.level_changes(stream, {"cpu": (80.0, 95.0)}), f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    got = rows(spark.read.parquet(f"{path}/rows"), "reading_id", "level_before", "level")
    assert got == [(2, "healthy", "warning"), (4, "warning", "critical"), (5, "critical", "healthy")]


def test_a_metric_is_forgotten_after_its_time_to_live(spark):
    path = fresh_path(spark, "levels")
    schema = "reading_id bigint, ts timestamp, metric string, value double"
    frames = [[(1, at(0), "cpu", 90.0)], [(2, at(200), "disk", 1.0)], [(3, at(201), "disk", 1.0)], [(4, at(205), "cpu", 90.0)]]
    with flow.on_rocksdb(spark):
        stream = alerts.level_changes(files(spark, frames, schema), {"cpu": (80.0, 95.0)}, time_to_live=timedelta(hours=1))
        orders.append_to(stream, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    assert rows(spark.read.parquet(f"{path}/rows"), "reading_id", "level_before") == [(1, "healthy"), (4, "healthy")]


def test_a_stop_between_the_two_outputs_loses_and_doubles_nothing(spark, monkeypatch):
    path = fresh_path(spark, "sinks")
    payloads = []
    for k in range(4):
        batch = [json.dumps({"InvoiceNo": f"{k}-{i}", "Quantity": i, "UnitPrice": 1.5}) for i in range(5)] + [f"broken {k}", json.dumps({"Quantity": k})]
        payloads += batch
        spark.createDataFrame([(p,) for p in batch], "value string").coalesce(1).write.mode("append").text(f"{path}/in")
    read = lambda: orders.read_order_stream(spark, f"{path}/in", files_per_batch=1)
    rejects, calls = orders._rejects, []

    def failing(batch):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("stopped between the outputs")
        return rejects(batch)

    monkeypatch.setattr(orders, "_rejects", failing)
    with pytest.raises(Exception, match="stopped between"):
        orders.order_sinks(read(), path).awaitTermination()
    assert spark.read.parquet(f"{path}/orders").count() == 15 and spark.read.parquet(f"{path}/dead_letters").count() == 4
    orders.order_sinks(read(), path).awaitTermination()
    taken = [r["InvoiceNo"] for r in spark.read.parquet(f"{path}/orders").collect()]
    assert sorted(taken) == sorted(f"{k}-{i}" for k in range(4) for i in range(5))
    letters = spark.read.parquet(f"{path}/dead_letters")
    assert sorted(r["value"] for r in letters.collect()) == sorted(p for p in payloads if "broken" in p or "InvoiceNo" not in p)
    assert {(r["reason"], tuple(r["rejected_fields"] or ())) for r in letters.collect()} == {("not JSON", ()), ("missing", ("InvoiceNo", "UnitPrice"))}


@pytest.mark.parametrize("ahead", [flow.READ_AHEAD, 0])
def test_buckets_of_orders_follow_each_order_by_itself(spark, monkeypatch, ahead):
    """Arrivals that replace each other, completions of nothing, and missing ids, times and numbers, over three batches."""
    monkeypatch.setattr(flow, "READ_AHEAD", ahead)
    pick, held, want, frames = random.Random(4), {}, [], []
    ids = [None, "", *[f"o{k}" for k in range(40)]]
    for batch in range(3):
        events = [(pick.choice(ids), pick.choice(["arrive", "complete", None]), at(1000 * batch + pick.randrange(900)), pick.randrange(50)) for _ in range(150)]
        events += [("late", k, t, n) for k, t, n in (("arrive", None, None), ("complete", None, 3)) if batch == 1]
        events = list({(e[0], e[2], e[3]): e for e in events}.values())
        frames.append(events)
        for order, kind, ts, _ in sorted(events, key=lambda e: (e[2] is not None, e[2] or DAY, e[3] is not None, e[3] or 0)):
            if kind == "arrive":
                held[order] = ts
            elif order in held:
                want.append((order, held.pop(order), ts))
    path = fresh_path(spark, "buckets")
    flow.order_flow(files(spark, frames, EVENTS), path).awaitTermination()
    completed = spark.read.parquet(f"{path}/completed")
    assert rows(completed, "order_id", "arrival_time", "completion_time") == sorted(want, key=repr)
    assert completed.select("batch_id").distinct().count() == 3 and ("late", None, None) in want
    assert rows(flow.last_open(spark, path), "order_id", "arrival_time") == sorted(held.items(), key=repr)
