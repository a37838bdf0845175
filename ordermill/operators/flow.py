"""Order flow: match completions to arrivals, and measure L, lambda and W of Little's law."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions import expressions as E
from ordermill.session import settled

def with_event_before(events: DataFrame) -> DataFrame:
    """Events ``order_id, kind, ts, seq`` with the struct ``before`` of the order's event before.

    ``seq`` orders events of one instant; events without an order id count as those of one order. The events are dealt
    out by ranges of order, time and seq, so an order with very many events lies in several ranges. The look-up runs
    within a range, and only the last event of an order in each range is carried on to its next one. The dealt-out
    events are kept on shared storage, as both steps read them.
    """
    spark = events.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = events.select("order_id", "kind", "ts", "seq").repartitionByRange(ranges, "order_id", "ts", "seq")
    dealt = settled(dealt.withColumn("part", F.spark_partition_id()))
    now = F.struct("kind", "ts")
    last = dealt.groupBy("order_id", "part").agg(F.max_by(now, F.struct("ts", "seq")).alias("last"))
    carried = last.select(
        F.col("order_id").alias("id"),
        F.col("part").alias("range"),
        F.lag("last").over(Window.partitionBy("order_id").orderBy("part")).alias("carried"),
    )
    inside = F.lag(now).over(Window.partitionBy("order_id", "part").orderBy("ts", "seq"))
    return (
        dealt.withColumn("inside", inside)
        .join(carried, F.col("order_id").eqNullSafe(F.col("id")) & (F.col("part") == F.col("range")))
        .select("order_id", "kind", "ts", "seq", F.coalesce("inside", "carried").alias("before"))
    )


def closes_order() -> Column:
    """A completion right after an arrival. Other completions find no open order."""
    return (F.col("kind") == "complete") & (F.col("before.kind") == "arrive")


def match_lifecycle(events: DataFrame) -> DataFrame:
    """Completed orders: arrival, completion and lead time.

    An order that arrives again while it is open counts from the later arrival.
    """
    return (
        with_event_before(events)
        .where(closes_order())
        .select("order_id", F.col("before.ts").alias("arrival_time"), F.col("ts").alias("completion_time"))
        .withColumn("lead_time_minutes", lead_micros() / 60000000)
    )


def lead_micros() -> Column:
    return F.unix_micros("completion_time") - F.unix_micros("arrival_time")


def mean_lead(micros: Column, n: Column) -> Column:
    """Mean lead time in minutes to two digits."""
    return E.mean(micros, n * 60000000)


def open_orders(events: DataFrame) -> DataFrame:
    """Orders whose last event is an arrival, with its time."""
    order = F.struct("ts", "seq")
    last = events.groupBy("order_id").agg(F.max_by(F.struct("kind", "ts", "seq"), order).alias("last"))
    return last.where(F.col("last.kind") == "arrive").select(
        "order_id", F.col("last.ts").alias("arrival_time"), F.col("last.seq").alias("seq")
    )


def littles_law(events: DataFrame, as_of: str, window_minutes: int = 60, include_open: bool = False) -> DataFrame:
    """L, arrival rate, lead time and their balance at ``as_of``.

    L counts open orders of any age. The rate counts arrivals after the window start, of
    completed orders only unless ``include_open``. The lead time is the mean over completions
    after the window start, 0 without any.
    """
    now = F.lit(as_of).cast("timestamp")
    start = now - F.make_dt_interval(mins=F.lit(window_minutes))
    seen = events.where(F.col("ts") <= now)
    still = open_orders(seen)
    recent_open = F.count_if(F.col("arrival_time") > start) if include_open else F.lit(0)
    waiting = still.agg(F.struct(F.count(F.lit(1)).alias("n"), recent_open.alias("recent"))).scalar()
    recent = F.col("completion_time") > start
    totals = match_lifecycle(seen).agg(
        F.count(F.lit(1)).alias("completed"),
        F.count_if(F.col("arrival_time") > start).alias("arrivals"),
        F.count_if(recent).alias("completions"),
        F.sum(F.when(recent, lead_micros())).alias("lead"),
    )
    measured = totals.withColumn("open", waiting).select(
        "completed",
        F.col("open.n").alias("l"),
        ((F.col("arrivals") + F.col("open.recent")) / window_minutes).alias("rate"),
        F.coalesce(F.try_divide(F.col("lead") / 60000000, F.col("completions")), F.lit(0.0)).alias("w"),
        F.coalesce(mean_lead(F.col("lead"), F.col("completions")), F.lit(0)).alias("lead_time"),
    )
    gap = F.abs(F.col("l") - F.col("rate") * F.col("w"))
    return measured.select(
        F.col("l").alias("l_work_in_progress"),
        F.round("rate", 3).alias("lambda_arrival_rate"),
        F.col("lead_time").cast("double").alias("w_lead_time_minutes"),
        F.round(F.col("rate") * F.col("w"), 2).alias("littles_law_predicted"),
        F.round(gap, 2).alias("difference"),
        (gap < 1.0).alias("is_balanced"),
        now.alias("as_of"),
        F.col("completed").alias("total_completed"),
    )


def flow_report(events: DataFrame, as_of: str, window_minutes: int = 60) -> DataFrame:
    """The flow metrics with totals and a status word."""
    status = F.when(F.col("is_balanced"), "balanced").otherwise("imbalanced")
    return littles_law(events, as_of, window_minutes).select(
        "*",
        F.col("total_completed").alias("total_orders_processed"),
        F.col("l_work_in_progress").alias("orders_currently_processing"),
        status.alias("system_status"),
    ).drop("total_completed")


def flow_windows(completed: DataFrame, minutes: int = 60, slide: int = 5) -> DataFrame:
    """Completions and mean lead time per sliding window; works on streams of completed orders."""
    return (
        completed.groupBy(F.window("completion_time", f"{minutes} minutes", f"{slide} minutes"))
        .agg(
            F.count(F.lit(1)).alias("completions"),
            F.sum(lead_micros()).alias("lead_micros"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "completions",
            mean_lead(F.col("lead_micros"), F.col("completions")).cast("double").alias("w_lead_time_minutes"),
            F.round(F.col("completions") / minutes, 3).alias("throughput_per_minute"),
        )
    )


def flow_changes(events: DataFrame) -> DataFrame:
    """``ts, change, lead_micros`` of every event: 1 where an order opens, -1 where one closes, with its lead time, else 0."""
    opens = (F.col("kind") == "arrive") & F.coalesce(F.col("before.kind") != "arrive", F.lit(True))
    change = F.when(opens, 1).when(closes_order(), -1).otherwise(0)
    lead = F.when(closes_order(), F.unix_micros("ts") - F.unix_micros("before.ts"))
    return with_event_before(events).select("ts", change.alias("change"), lead.alias("lead_micros"))


def change_sums(changes: DataFrame, minutes: int) -> DataFrame:
    """Changes per event-time window; works on streams."""
    return (
        changes.groupBy(F.window("ts", f"{minutes} minutes"))
        .agg(
            F.count_if(F.col("change") == 1).alias("arrivals"),
            F.count("lead_micros").alias("completions"),
            F.sum("lead_micros").alias("lead_micros"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "arrivals", "completions", "lead_micros")
    )


def law_of(windows: DataFrame, minutes: int, before: Column | None = None) -> DataFrame:
    """L, lambda and W of windows of ``change_sums``: L is the orders open at the end, a running sum from ``before`` on."""
    net = F.col("arrivals") - F.col("completions")
    upto = Window.orderBy("window_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return windows.select(
        "window_start",
        "window_end",
        (F.sum(net).over(upto) + (F.lit(0) if before is None else before)).alias("l_work_in_progress"),
        F.round(F.col("arrivals") / minutes, 3).alias("lambda_arrival_rate"),
        mean_lead(F.col("lead_micros"), F.col("completions")).cast("double").alias("w_lead_time_minutes"),
        "arrivals",
        "completions",
    )


def law_windows(events: DataFrame, minutes: int = 60) -> DataFrame:
    """L, lambda and W in every window with events. The running sum is over windows, not events."""
    return flow_changes(events).transform(change_sums, minutes).transform(law_of, minutes)


def open_by_hour(events: DataFrame) -> DataFrame:
    """Open orders at the end of every hour with events: a running sum over hourly changes."""
    opens = (F.col("kind") == "arrive") & F.coalesce(F.col("before.kind") != "arrive", F.lit(True))
    change = F.when(opens, 1).when(closes_order(), -1).otherwise(0)
    hour = F.date_trunc("hour", "ts").alias("hour")
    net = with_event_before(events).groupBy(hour).agg(F.sum(change).alias("net_change"))
    return net.withColumn("open_orders", F.sum("net_change").over(Window.orderBy("hour")))
