"""Order flow on streams: completed orders, open orders and windowed lead times.

What carries over between micro-batches is the arrival of each open order, in Spark's keyed state on RocksDB: a batch
reads and changes only the orders it has events of. A timer gives an order up that stays open for too long. Without one,
orders are followed many at a time, in buckets of their ids, and only what a batch leaves open or closes is a round trip
to the state.
"""

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ordermill.operators.flow import change_sums, flow_windows, law_of, lead_micros

OPEN = "arrival_time timestamp, seq bigint"
OPEN_MICROS = "micros bigint, seq bigint"
MATCHED = "order_id string, arrived bigint, completed bigint"
#: Parts that orders are dealt into by their ids, whatever the size of a batch. A checkpoint keeps to their number.
BUCKETS = 1024
#: Open orders of a bucket that are read at once, as many for each order of a batch; beyond that each is looked up by itself.
READ_AHEAD = 8
CHANGE = "ts timestamp, change int, lead_micros bigint"
LAW = (
    "window_start timestamp, window_end timestamp, l_work_in_progress bigint, lambda_arrival_rate double, "
    "w_lead_time_minutes double, arrivals bigint, completions bigint"
)
OUTCOME = "order_id string, arrival_time timestamp, completion_time timestamp"
LATENESS = "10 minutes"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# The tracker goes to the Python workers whole: those that set a stream up see no files the session was given.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class OrderTracker(StatefulProcessor):
    """Matches completions to arrivals, order by order.

    An order that arrives again while it is open counts from the later arrival; a completion without an open order is
    left out. Rows come out when an order completes, or without a completion when it is given up.
    """

    def __init__(self, give_up: timedelta | None):
        self.give_up = give_up

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # each look at the state is a round trip: one to read it, one more only where it changes
        arrival = before = self.open.get()
        for row in sorted(rows, key=lambda r: (r.ts, r.seq)):
            if row.kind == "arrive":
                arrival = (row.ts, row.seq)
            elif arrival is not None:
                yield Row(order_id=key[0], arrival_time=arrival[0], completion_time=row.ts)
                arrival = None
        if self.give_up is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if arrival is None:
            if before is not None:
                self.open.clear()
            return
        self.open.update(tuple(arrival))
        if self.give_up is not None:
            self.handle.registerTimer(int((arrival[0] + self.give_up).timestamp() * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists():
            yield Row(order_id=key[0], arrival_time=self.open.get()[0], completion_time=None)
            self.open.clear()

    def close(self) -> None:
        pass


class BucketTracker(StatefulProcessor):
    """``OrderTracker`` for a bucket of orders at a time, without giving any up.

    Events come as ``order_id, arrives, micros, seq``. Those of one order follow each other by time and seq, missing ones
    first; most orders of a batch are settled by that alone. The open orders of the bucket are read together as long as
    there are not many more than orders in the batch, else order by order.
    """

    def init(self, handle) -> None:
        self.open = handle.getMapState("open", "order_id string", OPEN_MICROS)

    def _before(self, orders: list) -> dict:
        """The open ones among ``orders`` with their arrivals."""
        if not self.open.exists():
            return {}
        most = READ_AHEAD * (len(orders) + 100)
        held = list(islice(self.open.iterator(), most + 1))
        if len(held) <= most:
            wanted = set(orders)
            return {key[0]: value for key, value in held if key[0] in wanted}
        found = ((order, self.open.getValue((order,))) for order in orders)
        return {order: tuple(value) for order, value in found if value is not None}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows), ignore_index=True)
        code, orders = pd.factorize(events["order_id"], use_na_sentinel=False)
        orders = [None if pd.isna(order) else order for order in orders]
        micros, seq = (events[c].astype("Int64") for c in ("micros", "seq"))
        timed, numbered = micros.notna().to_numpy(), seq.notna().to_numpy()
        micros, seq = (c.fillna(0).to_numpy(np.int64) for c in (micros, seq))
        arrives = events["arrives"].to_numpy(bool)
        order = np.lexsort((seq, numbered, micros, timed, code))
        code, micros, timed, seq, numbered, arrives = (c[order] for c in (code, micros, timed, seq, numbered, arrives))
        first, last = np.diff(code, prepend=-1) != 0, np.diff(code, append=-1) != 0
        # a completion right after an arrival closes the order; the first event of an order may follow one in the state
        closes = ~arrives & ~first & np.roll(arrives, 1)
        at = np.flatnonzero(closes)
        value = lambda k: (int(micros[k]) if timed[k] else None, int(seq[k]) if numbered[k] else None)
        before = self._before(orders)
        begun = [k for k in np.flatnonzero(first & ~arrives) if orders[code[k]] in before] if before else []
        # numbers and whether they are known, of arrivals in the batch and of those in the state
        earlier = [before[orders[code[k]]][0] for k in begun]
        arrived = np.concatenate([micros[at - 1], np.array([m or 0 for m in earlier], dtype=np.int64)])
        known = np.concatenate([timed[at - 1], np.array([m is not None for m in earlier], dtype=bool)])
        at = np.concatenate([at, np.array(begun, dtype=np.int64)])
        names = np.array([*orders, None], dtype=object)[code[at]]
        yield pd.DataFrame(
            {"order_id": pd.Series(names, dtype=object), "arrived": pd.arrays.IntegerArray(arrived, ~known), "completed": pd.arrays.IntegerArray(micros[at], ~timed[at])}
        )
        for k in np.flatnonzero(last):
            name = orders[code[k]]
            if arrives[k]:
                self.open.updateValue((name,), value(k))
            elif name in before:
                self.open.removeKey((name,))

    def close(self) -> None:
        pass


class ChangeTracker(StatefulProcessor):
    """Tells for every event by how much it changes the number of open orders, and the lead time of one that closes."""

    def init(self, handle) -> None:
        self.open = handle.getValueState("open", "micros bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.open.get()
        arrival = None if before is None else before[0]
        for row in sorted(rows, key=lambda r: (r.micros, r.seq)):
            change, lead = 0, None
            if row.kind == "arrive":
                change, arrival = int(arrival is None), row.micros
            elif arrival is not None:
                change, lead, arrival = -1, row.micros - arrival, None
            yield Row(ts=row.ts, change=change, lead_micros=lead)
        if arrival is None:
            if before is not None:
                self.open.clear()
        else:
            self.open.update((arrival,))

    def close(self) -> None:
        pass


@contextmanager
def on_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that start meanwhile keep their state on RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def _followed(events: DataFrame) -> DataFrame:
    """Completed orders of a stream of events, by buckets of orders."""
    arrives = F.coalesce(F.col("kind") == "arrive", F.lit(False))
    bucket = F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)).alias("bucket")
    source = events.select(bucket, "order_id", arrives.alias("arrives"), F.unix_micros("ts").alias("micros"), "seq")
    matched = source.groupBy("bucket").transformWithStateInPandas(BucketTracker(), MATCHED, "append", "none")
    times = [F.timestamp_micros(c).alias(name) for c, name in (("arrived", "arrival_time"), ("completed", "completion_time"))]
    return matched.select("order_id", *times)


def order_flow(events: DataFrame, folder: str, give_up: timedelta | None = None, lateness: str = LATENESS) -> StreamingQuery:
    """Match a stream of lifecycle events ``order_id, kind, ts, seq``.

    Completed orders go to ``folder/completed``, per batch. With ``give_up`` orders that are open for longer than that
    when the watermark, ``lateness`` behind the newest event, comes by are written to ``folder/expired`` and forgotten.
    All events of one order in one micro-batch are sorted in one task; without ``give_up`` those of a bucket of orders.
    """
    spark = events.sparkSession
    if give_up is None:
        outcomes = _followed(events)
    else:
        source = events.select("order_id", "kind", "ts", "seq").withWatermark("ts", lateness)
        outcomes = source.groupBy("order_id").transformWithState(OrderTracker(give_up), OUTCOME, "append", "eventTime")
    lead = lead_micros() / 60000000

    def step(batch: DataFrame, batch_id: int) -> None:
        target = f"batch_id={batch_id}"
        if give_up is None:
            batch.withColumn("lead_time_minutes", lead).write.mode("overwrite").parquet(f"{folder}/completed/{target}")
            return
        done = F.col("completion_time").isNotNull()
        batch = batch.persist()
        try:
            batch.where(done).withColumn("lead_time_minutes", lead).write.mode("overwrite").parquet(f"{folder}/completed/{target}")
            batch.where(~done).drop("completion_time").write.mode("overwrite").parquet(f"{folder}/expired/{target}")
        finally:
            batch.unpersist()

    with on_rocksdb(spark):
        return (
            outcomes.writeStream.foreachBatch(step)
            .option("checkpointLocation", f"{folder}/_checkpoint")
            .trigger(availableNow=True)
            .start()
        )


def law_on_stream(events: DataFrame, folder: str, minutes: int = 60, lateness: str = LATENESS) -> StreamingQuery:
    """L, lambda and W of every window of a stream of lifecycle events, once the watermark has passed it.

    Orders are followed in keyed state, their changes are summed up in windows by a second stateful step, and L goes
    on from the sum of what earlier micro-batches have written to ``folder/windows``.
    """
    spark = events.sparkSession
    source = events.select("order_id", "kind", "ts", F.unix_micros("ts").alias("micros"), "seq").withWatermark("ts", lateness)
    changes = source.groupBy("order_id").transformWithState(ChangeTracker(), CHANGE, "append", "eventTime", eventTimeColumnName="ts")
    target = f"{folder}/windows"

    # so that there is a table to read before the first batch
    spark.createDataFrame([], LAW).write.mode("ignore").parquet(f"{target}/batch_id=-1")

    def step(batch: DataFrame, batch_id: int) -> None:
        earlier = batch.sparkSession.read.schema(f"{LAW}, batch_id bigint").parquet(target).where(F.col("batch_id") < batch_id)
        before = earlier.agg(F.coalesce(F.sum(F.col("arrivals") - F.col("completions")), F.lit(0))).first()[0]
        law_of(batch, minutes, F.lit(before)).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    with on_rocksdb(spark):
        return (
            change_sums(changes, minutes)
            .writeStream.foreachBatch(step)
            .option("checkpointLocation", f"{folder}/_checkpoint")
            .trigger(availableNow=True)
            .start()
        )


def joined_flow(events: DataFrame, within: str = "1 hour", lateness: str = LATENESS) -> DataFrame:
    """Completions joined to arrivals of orders that arrive and complete once, on a stream and without Python.

    An arrival waits for its completion for up to ``within``; when the watermark has passed that, it comes out without
    one and leaves the state. Both sides are shuffled by order, so the state holds what arrived within the bound.
    """
    late = events.withWatermark("ts", lateness)
    arrived = late.where("kind = 'arrive'").select("order_id", F.col("ts").alias("arrival_time"))
    done = late.where("kind = 'complete'").select(F.col("order_id").alias("done_id"), F.col("ts").alias("completion_time"))
    bound = (F.col("completion_time") >= F.col("arrival_time")) & (F.col("completion_time") <= F.col("arrival_time") + F.expr(f"interval {within}"))
    joined = arrived.join(done, (F.col("order_id") == F.col("done_id")) & bound, "left_outer")
    return joined.select("order_id", "arrival_time", "completion_time", (lead_micros() / 60000000).alias("lead_time_minutes"))


def last_open(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that are open after the newest batch, read from the state itself."""
    state = spark.read.format("statestore").option("path", f"{folder}/_checkpoint").option("stateVarName", "open").load()
    if "user_map_key" not in state.columns:
        return state.select("key.order_id", "value.arrival_time", "value.seq")
    arrived = F.timestamp_micros("user_map_value.micros").alias("arrival_time")
    return state.select("user_map_key.order_id", arrived, "user_map_value.seq")


def windowed_flow(completed: DataFrame, minutes: int = 60, slide: int = 5, lateness: str = LATENESS) -> DataFrame:
    """``flow_windows`` over a stream of completed orders; windows that the watermark has passed leave the state."""
    return flow_windows(completed.withWatermark("completion_time", lateness), minutes, slide)
