"""Alerts on streams of metric readings."""

import sys
from array import array
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ordermill import schema as S
from ordermill.operators.metrics import status_level

CHANGED = "metric string, micros bigint, reading_id bigint, level_before string, level string"
LATENESS = "10 minutes"
#: Stands for a reading without an id, which is before all others of its instant.
NO_ID = -(1 << 63)
# The tracker goes to the Python workers whole: those that set a stream up see no files the session was given.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LevelTracker(StatefulProcessor):
    """Remembers each metric's last level and gives a row where it changes.

    A metric begins as healthy, and begins again when the watermark is the time to live past its last reading.
    """

    def __init__(self, time_to_live: timedelta | None):
        self.time_to_live = time_to_live

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "level string, micros bigint, reading_id bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        level, micros, reading_id = tuple(self.last.get() or ("healthy", None, None))
        # 17 bytes a reading: as rows, those of one metric would take many times the room
        times, ids, codes, names = array("q"), array("q"), array("b"), {level: 0}
        for row in rows:
            times.append(row.micros)
            ids.append(NO_ID if row.reading_id is None else row.reading_id)
            codes.append(names.setdefault(row.status, len(names)))
        times, ids, codes = np.frombuffer(times, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(codes, np.int8)
        order = np.lexsort((ids, times))
        if micros is not None:  # where later readings have been seen, the level isn't of then any more
            last_id = NO_ID if reading_id is None else reading_id
            order = order[(times[order] > micros) | ((times[order] == micros) & (ids[order] > last_id))]
        found = codes[order]
        before = np.concatenate([np.zeros(1, np.int8), found[:-1]]) if len(found) else found
        known = list(names)
        for k in np.flatnonzero(found != before):
            at = order[k]
            own = None if ids[at] == NO_ID else int(ids[at])
            yield Row(metric=key[0], micros=int(times[at]), reading_id=own, level_before=known[before[k]], level=known[found[k]])
        if len(order):
            at = order[-1]
            level, micros, reading_id = known[codes[at]], int(times[at]), None if ids[at] == NO_ID else int(ids[at])
        last = level, micros, reading_id
        self.last.update(last)
        if self.time_to_live is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(last[1] // 1000 + self.time_to_live // timedelta(milliseconds=1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def level_changes(
    readings: DataFrame, thresholds: dict = S.METRIC_THRESHOLDS, lateness: str = LATENESS, time_to_live: timedelta | None = None
) -> DataFrame:
    """A stream of readings ``reading_id, ts, metric, value`` as alerts, one wherever a metric's level changes.

    Readings that are sent again within the lateness count once. The levels are worked out where the readings are
    read. Needs state on RocksDB (``flow.on_rocksdb``). The readings of one metric in one micro-batch are sorted in
    one task, as arrays of 17 bytes a reading; what is carried on is one row a metric.
    """
    once = readings.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["reading_id"])
    levels = status_level(once, thresholds).select("metric", "ts", F.unix_micros("ts").alias("micros"), "reading_id", "status")
    changes = levels.groupBy("metric").transformWithState(LevelTracker(time_to_live), CHANGED, "append", "eventTime")
    return changes.withColumn("micros", F.timestamp_micros("micros")).withColumnRenamed("micros", "ts")
