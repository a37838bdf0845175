"""What a step holds, reads or asks for, where its results don't tell."""

import tracemalloc
from datetime import datetime, timedelta
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from ordermill.operators import features
from ordermill.streaming import alerts, flow
from ordermill.streaming import orders as stream


class State:
    """One keyed value, and the looks at it."""

    def __init__(self, value=None):
        self.value, self.calls = value, []

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = tuple(value)

    def clear(self):
        self.calls.append("clear")
        self.value = None


def reading(micros, reading_id, status):
    return SimpleNamespace(micros=micros, reading_id=reading_id, status=status, ts=datetime(2024, 1, 1) + timedelta(microseconds=micros))


def levels(state, rows):
    tracker = alerts.LevelTracker(None)
    tracker.handle, tracker.last = None, state
    return list(tracker.handleInputRows(("cpu",), iter(rows), None))


def test_readings_of_a_metric_are_small():
    n = 100_000
    tracemalloc.start()
    try:
        assert len(levels(State(), (reading(10**12 + k * 7919 % n, 10**9 + k, "healthy") for k in range(n)))) == 0
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 * n


def test_levels_follow_time_then_id():
    state = State(("warning", 100, 5))
    late = [reading(100, 5, "critical"), reading(99, 9, "critical"), reading(100, None, "critical")]
    found = levels(state, [reading(300, 1, None), reading(200, 7, "healthy"), reading(200, 6, "warning"), *late, reading(100, 6, "warning")])
    assert [(r.reading_id, r.level_before, r.level) for r in found] == [(7, "warning", "healthy"), (1, "healthy", None)]
    assert state.value == (None, 300, 1)


def test_only_late_readings_change_nothing():
    state = State(("warning", 100, 5))
    assert levels(state, [reading(50, 1, "critical")]) == []
    assert state.value == ("warning", 100, 5)


def test_an_order_that_completes_at_once_costs_one_look():
    rows = [SimpleNamespace(kind=k, ts=datetime(2024, 1, 1, h), micros=h, seq=h) for k, h in (("arrive", 1), ("complete", 2))]
    for tracker in (flow.OrderTracker(None), flow.ChangeTracker()):
        tracker.open = State()
        assert list(tracker.handleInputRows(("7",), rows, None))
        assert tracker.open.calls == ["get"]


def test_an_open_order_leaves_the_state_when_it_completes():
    tracker = flow.OrderTracker(None)
    tracker.open = State((datetime(2024, 1, 1, 1), 1))
    done = [SimpleNamespace(kind="complete", ts=datetime(2024, 1, 1, 2), seq=2)]
    assert [r.arrival_time.hour for r in tracker.handleInputRows(("7",), done, None)] == [1]
    assert tracker.open.value is None


class Map:
    """Keyed values, and the round trips to them: each call is one, and every hundred entries of an iterator."""

    def __init__(self, held=()):
        self.held, self.trips = dict(held), 0

    def exists(self):
        self.trips += 1
        return bool(self.held)

    def iterator(self):
        for k, entry in enumerate(list(self.held.items())):
            self.trips += k % 100 == 0
            yield entry

    def getValue(self, key):
        self.trips += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.trips += 1
        self.held[key] = value

    def removeKey(self, key):
        self.trips += 1
        del self.held[key]


def followed(state, events):
    tracker = flow.BucketTracker()
    tracker.open = state
    frames = [pd.DataFrame(events[k : k + 700], columns=["order_id", "arrives", "micros", "seq"]) for k in range(0, len(events), 700)]
    return sorted(tuple(None if pd.isna(v) else v for v in r) for out in tracker.handleInputRows((1,), iter(frames), None) for r in out.itertuples(index=False))


def test_orders_that_a_batch_settles_cost_no_look_each():
    events = [(f"o{k}", a, 10 * k + 3 * (not a), 2 * k + (not a)) for a in (False, True) for k in range(1000)]
    state = Map()
    assert followed(state, events) == sorted((f"o{k}", 10 * k, 10 * k + 3) for k in range(1000))
    assert state.trips == 1
    state = Map({(f"o{k}",): (-5, 0) for k in range(300)})
    completions = [("o7", False, 1, 1), *[(f"o{k}", True, 2, 2) for k in range(400, 900)], ("x", False, 1, 1)]
    assert followed(state, completions) == [("o7", -5, 1)]
    assert len(state.held) == 799 and state.trips == 1 + 3 + 500 + 1


def test_few_orders_are_looked_up_among_many_open_ones():
    state = Map({(f"o{k}",): (k, 0) for k in range(5000)})
    assert followed(state, [("o4999", False, 9000, 1), ("new", True, 1, 2)]) == [("o4999", 4999, 9000)]
    assert state.trips < 20 and len(state.held) == 5000 and state.held["new",] == (1, 2)


def test_orders_are_judged_without_lambdas(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    assert "lambda" not in stream.parse_orders(messages)._jdf.queryExecution().optimizedPlan().toString()


def test_one_sink_keeps_no_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\n")
    for names in (["one"], ["one", "two"]):
        kept, folder = [], str(tmp_path / "-".join(names))
        sinks = {name: lambda batch: kept.append(batch.is_cached) or batch for name in names}
        stream.write_batches(stream.read_order_stream(spark, str(tmp_path / "in")), sinks, folder).awaitTermination()
        assert kept == [len(names) > 1] * len(names)
        assert spark.read.parquet(f"{folder}/one").count() == 2


def test_prepared_data_reads_the_raw_lines_once(spark, orders, tmp_path, monkeypatch):
    rows = [(str(k), str(k % 7), f"p{k % 3}", k % 5 + 1, f"2024-01-{k % 28 + 1:02d} 10:00:00", 1.5 + k % 4, 100 + k, "France") for k in range(200)]
    orders(*rows).write.parquet(str(tmp_path / "raw"))
    raw, read, settled = spark.read.parquet(str(tmp_path / "raw")), [], features.settled

    def watched(df):
        read.append(any("/raw/" in f for f in df.inputFiles()))
        return settled(df)

    monkeypatch.setattr(features, "settled", watched)
    train, test, _ = features.prepare_ml_dataset(raw)
    assert sum(read) == 1
    assert train.unionByName(test).agg(F.count_distinct("row_key")).first()[0] == train.count() + test.count()
