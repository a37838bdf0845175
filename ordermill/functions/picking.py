"""Top-n and repeatable sampling for row counts too large for one final merge."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.expressions import key_number, keyed

MERGE_WAYS = 64
KEY_BUCKETS = 1 << 16
ROWS_PER_PART = 5000


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows in ``order``.

    A plain sort-and-limit sends up to ``n`` rows of every input partition to one task, so the
    partitions first merge in ``MERGE_WAYS`` tasks that keep ``n`` rows each.
    """
    way = Window.partitionBy("_way").orderBy(*order)
    merged = (
        df.withColumn("_way", F.spark_partition_id() % MERGE_WAYS)
        .withColumn("_place", F.row_number().over(way))
        .where(F.col("_place") <= n)
        .drop("_way", "_place")
    )
    return merged.orderBy(*order).limit(n)


def top_n_by(df: DataFrame, n: int, by: list[str], *order: Column) -> DataFrame:
    """First ``n`` rows in ``order`` of every ``by``, with their ``place``, merged in two steps like ``top_n``."""
    way = Window.partitionBy(*by, "_way").orderBy(*order)
    merged = (
        df.withColumn("_way", F.spark_partition_id() % MERGE_WAYS)
        .withColumn("_place", F.row_number().over(way))
        .where(F.col("_place") <= n)
        .drop("_way", "_place")
    )
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return merged.withColumn("place", place).where(F.col("place") <= n)


def sample_n(df: DataFrame, n: int, key: Column, seed: int | None = None) -> DataFrame:
    """Repeatable pick of ``n`` rows: those with the smallest hashed key.

    A histogram of the key tells beforehand which part of the key space holds the first ``n``
    rows, so the rest is filtered out where it is read instead of being sorted. Rows that tie
    on the key are copies of each other, whichever of them is taken.
    """
    hashed = keyed(key, seed)
    bucket = F.shiftright(key_number(F.col("_key")), 16)
    tagged = df.withColumn("_key", hashed).withColumn("_bucket", bucket)
    until = Window.orderBy("_bucket")
    cut = (
        tagged.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("until", F.sum("rows").over(until))
        .agg(
            F.coalesce(
                F.min(F.when(F.col("until") >= n, F.col("_bucket"))), F.lit(KEY_BUCKETS)
            )
        )
    )
    picked = tagged.where(F.col("_bucket") <= cut.scalar())
    best = top_n(picked, n, F.col("_key").asc()).repartition(-(-n // ROWS_PER_PART), "_key")
    return best.drop("_key", "_bucket")


def latest_n(df: DataFrame, n: int, time: str, *ties: Column) -> DataFrame:
    """The ``n`` newest rows. Days that cannot hold any of them are filtered out first."""
    day = F.to_date(time)
    order = Window.orderBy(F.desc("_day"))
    cut = (
        df.where(F.col(time).isNotNull())
        .groupBy(day.alias("_day"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("until", F.sum("rows").over(order))
        .agg(F.coalesce(F.max(F.when(F.col("until") >= n, F.col("_day"))), F.min("_day")))
    )
    return top_n(df.where(day >= cut.scalar()), n, F.col(time).desc(), *ties)
