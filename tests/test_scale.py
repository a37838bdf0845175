"""Quantiles, picks and order flow under skew, against brute force."""

import random

import numpy as np
import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from ordermill.functions.expressions import row_key
from ordermill.functions.picking import latest_n, sample_n, top_n
from ordermill.functions.quantiles import exact_quantiles
from ordermill.operators.features import label_dictionary
from ordermill.operators.flow import littles_law, match_lifecycle, open_orders, with_event_before
from ordermill.operators.metrics import latest_metrics, latest_per_metric

FRACTIONS = [0.0, 0.25, 0.33, 0.5, 0.67, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("few", [1 << 21, 0])
@pytest.mark.parametrize("kind", ["hot", "wide", "negative", "single"])
def test_quantiles_are_exact(spark, few, kind):
    draw = random.Random(7)
    values = {
        "hot": [5] * 700 + [draw.randrange(1000) for _ in range(1300)],
        "wide": [draw.randrange(1 << 60) for _ in range(500)] + list(range(20)),
        "negative": [draw.randrange(-(1 << 40), 1 << 40) for _ in range(500)],
        "single": [42],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    got = exact_quantiles(df, ["v"], FRACTIONS, few=few)["v"]
    assert got == pytest.approx(list(np.quantile(np.array(values, dtype=float), FRACTIONS)), rel=1e-12)


def test_quantiles_of_several_columns_with_weights(spark):
    df = spark.createDataFrame([(1, "1.50", 3), (2, "9.00", 1), (7, None, 2)], "a int, t string, n bigint")
    df = df.withColumn("b", F.col("t").cast("decimal(10,2)"))
    got = exact_quantiles(df, ["a", "b"], [0.5, 1.0], weight="n")
    assert got == {"a": [1.5, 7.0], "b": [1.5, 9.0]}
    assert exact_quantiles(df.where("false"), ["a"], [0.5]) == {"a": [None]}


def test_quantiles_refuse_floating_columns(spark):
    with pytest.raises(TypeError):
        exact_quantiles(spark.range(3).select(F.rand().alias("x")), ["x"], [0.5])


def test_large_top_n_equals_sort_and_limit(spark):
    df = spark.range(0, 20000, numPartitions=16).select(F.col("id"), (F.hash("id") % 500).alias("v"))
    order = [F.desc("v"), F.col("id").asc()]
    assert rows(top_n(df, 3000, *order)) == rows(df.orderBy(*order).limit(3000))


def test_sample_takes_the_smallest_keys_even_if_copies_prevail(spark):
    copies = spark.range(0, 3000).select(F.lit(1).cast("bigint").alias("id"))
    df = spark.range(0, 6000).unionByName(copies)
    key = F.md5(F.col("id").cast("string"))
    for n in (10, 1500, 20000):
        picked = sample_n(df, n, key)
        want = sorted(r[0] for r in df.select(key).collect())[:n]
        assert sorted(r[0] for r in picked.select(key).collect()) == want
    assert rows(sample_n(df, 100, key, seed=1)) != rows(sample_n(df, 100, key, seed=2))


def test_latest_n_skips_old_days(spark):
    df = spark.range(0, 5000).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("at"))
    assert rows(latest_n(df, 1500, "at"), "id") == rows(df.orderBy(F.desc("at")).limit(1500), "id")
    assert latest_n(df, 9000, "at").count() == 5000


def replay(events):
    """The flow tracker by hand: one dictionary, events in order."""
    still, done = {}, []
    for order, kind, ts, _ in sorted(events, key=lambda e: (e[2], e[3])):
        if kind == "arrive":
            still[order] = ts
        elif order in still:
            done.append((order, still.pop(order), ts))
    return still, done


def lifecycle(n, seed=3):
    """A third of all events belong to one order."""
    draw = random.Random(seed)
    return [
        ("hot" if draw.random() < 0.33 else f"o{draw.randrange(n // 4)}", draw.choice(["arrive", "complete"]), draw.randrange(20000), i)
        for i in range(n)
    ]


def as_frame(spark, events):
    df = spark.createDataFrame(events, "order_id string, kind string, t bigint, seq bigint")
    return df.withColumn("ts", F.timestamp_seconds("t")).drop("t")


def test_flow_matches_replay(spark):
    events = lifecycle(3000)
    still, done = replay(events)
    df = as_frame(spark, events)
    got = match_lifecycle(df).select("order_id", F.unix_seconds("arrival_time"), F.unix_seconds("completion_time"))
    assert rows(got) == sorted(done, key=repr)
    assert rows(open_orders(df).select("order_id", F.unix_seconds("arrival_time"))) == sorted(still.items(), key=repr)


def test_one_order_in_one_instant_lies_in_several_ranges(spark):
    """A hot order id, all of its events in one second, and events without an id."""
    events = [("hot", ("arrive", "complete")[i % 2], 5, i) for i in range(8000)]
    events += [(None, "arrive", 1, 9000), (None, "complete", 61, 9001)]
    got = match_lifecycle(as_frame(spark, events).repartition(8))
    assert got.groupBy("order_id").count().orderBy("order_id").collect() == [(None, 1), ("hot", 4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = with_event_before(as_frame(spark, events).repartition(8)).groupBy(F.spark_partition_id()).count()
        assert sizes.agg(F.max("count")).first()[0] < 6000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_common_prefix_of_labels_lies_in_several_ranges(spark):
    df = spark.range(4000).select(F.format_string("SKU-%06d", F.col("id") * 7 % 4000).alias("code"))
    got = label_dictionary(df.union(spark.createDataFrame([(None,)], "code string")), ["code"])
    want = sorted([*(f"SKU-{k:06d}" for k in range(4000)), "nan"])
    assert [r["category"] for r in got.orderBy("code").collect()] == want
    assert [r["code"] for r in got.orderBy("code").collect()] == list(range(4001))


def test_one_metric_over_many_partitions(spark):
    df = spark.range(0, 200_000, numPartitions=200).select(
        F.col("id").alias("reading_id"), F.timestamp_seconds(F.col("id") * 7919 % 200_000).alias("ts"),
        F.lit("cpu").alias("metric"), F.lit(1.0).alias("value"),
    )
    want = [r["reading_id"] for r in df.orderBy(F.desc("ts"), F.desc("reading_id")).limit(100).collect()]
    assert [r["reading_id"] for r in latest_per_metric(df).orderBy("place").collect()] == want
    assert {r["reading_id"] for r in latest_metrics(df).collect()} == set(want)


def test_rows_that_differ_in_country_alone_have_other_keys(orders):
    line = ("1", "A", "x", 2, "2024-01-01 10:00:00", 1.5, 7)
    keys = orders((*line, "UK"), (*line, "US"), (*line, None), (*line, "UK"), ("1", "A", None, 2, None, 1.5, 7, "xUK"))
    assert keys.select(row_key().alias("k")).distinct().count() == 4


def test_littles_law_window_starts_after_its_bound(spark):
    minute = 60
    events = [("a", "arrive", 0, 1), ("a", "complete", 30 * minute, 2), ("b", "arrive", 10 * minute, 3),
              ("c", "arrive", 1 * minute, 4), ("c", "complete", 61 * minute, 5)]
    df = as_frame(spark, events)
    # The window of 60 minutes to 01:00 leaves out the arrival at 00:00.
    got = littles_law(df, "1970-01-01 01:00:00").first()
    assert (got["l_work_in_progress"], got["lambda_arrival_rate"], got["w_lead_time_minutes"]) == (2, 0.0, 30.0)
    later = littles_law(df, "1970-01-01 01:01:00").first()
    assert (later["l_work_in_progress"], later["w_lead_time_minutes"]) == (1, 45.0)
    with_open = littles_law(df, "1970-01-01 01:00:00", include_open=True).first()
    assert with_open["lambda_arrival_rate"] == round(2 / 60, 3)


def test_flow_without_events(spark):
    got = littles_law(as_frame(spark, lifecycle(8)).where("false"), "2024-01-01 00:00:00").first()
    assert (got["l_work_in_progress"], got["w_lead_time_minutes"], got["is_balanced"]) == (0, 0.0, True)
