"""Places in a sort order, without a task that holds more than one range of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.store import written

#: ``monotonically_increasing_id`` counts rows in its lower bits and partitions above them.
ROW_BITS = 33


def in_ranges(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """``df`` stored in sorted ranges of ``keys``, with ``part``, the number of the range, and ``at``, the place in it.

    Rows of equal keys are told apart by where they stood, so they never have to fit into one range. ``df`` is read
    twice, once for the bounds of the ranges: a stored table of few bytes a row is best.
    """
    order = [*keys, F.col("tie").asc()]
    dealt = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    stored = written(dealt.drop("tie").withColumn("spot", at), name)
    spot = F.col("spot")
    return stored.withColumn("part", F.shiftright(spot, ROW_BITS)).withColumn("at", spot.bitwiseAND(F.lit((1 << ROW_BITS) - 1))).drop("spot")


def numbered(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """``df`` with ``row_number``, its place from 0 on in the order of ``keys`` over all rows."""
    dealt = in_ranges(df, keys, name)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range, of which there are at most as many as shuffle partitions
    offsets = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return dealt.join(F.broadcast(offsets), "part").withColumn("row_number", F.col("before") + F.col("at")).drop("part", "at", "before")
