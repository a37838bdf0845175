"""Customer lifetime values and segments."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.functions.quantiles import quantile_columns
from ordermill.operators.cleaning import valid_sales, with_revenue
from ordermill.session import settled


def customer_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("CustomerID").agg(
        F.sum("Revenue").cast(S.MONEY).alias("total_revenue"),
        F.count_distinct("InvoiceNo").alias("order_frequency"),
    )


def segment_of(value: Column, floors: dict) -> Column:
    """First segment, from the best down, whose floor ``value`` reaches."""
    pick = F
    for name, floor in floors.items():
        pick = pick.when(value >= floor, name)
    return pick.otherwise(S.LOWEST_SEGMENT)


def customer_segments_fixed(raw: DataFrame, floors: dict = S.SEGMENT_FLOORS) -> DataFrame:
    """Size, mean revenue and mean order count of the segments with fixed revenue floors."""
    customers = raw.transform(valid_sales, require_date=False).transform(with_revenue).transform(customer_totals)
    n = F.count(F.lit(1))
    return (
        customers.groupBy(segment_of(F.col("total_revenue"), floors).alias("customer_segment"))
        .agg(
            n.alias("customer_count"),
            E.mean(F.sum("total_revenue"), n).alias("avg_revenue"),
            E.mean(F.sum("order_frequency"), n).alias("avg_order_frequency"),
        )
        .orderBy(F.desc("avg_revenue"), "customer_segment")
    )


def customer_lifetime(lines: DataFrame) -> DataFrame:
    """Per customer totals, first and last order, and whole 24-hour periods between them."""
    first, last = F.min("InvoiceDate"), F.max("InvoiceDate")
    return lines.groupBy("CustomerID").agg(
        F.sum("Revenue").cast(S.MONEY).alias("total_revenue"),
        F.count_distinct("InvoiceNo").alias("order_frequency"),
        F.sum("Quantity").alias("total_quantity"),
        first.alias("first_order"),
        last.alias("last_order"),
        F.timestamp_diff("DAY", first, last).alias("days_active"),
    )


def with_quantile_segment(customers: DataFrame, quantiles: dict = S.SEGMENT_QUANTILES) -> DataFrame:
    """Add the segment whose revenue quantile the customer reaches."""
    cuts = quantile_columns(customers, "total_revenue", list(quantiles.values()))
    floors = dict(zip(quantiles, cuts))
    return customers.withColumn("segment", segment_of(F.col("total_revenue").cast("double"), floors))


def customer_segments_quantile(lines: DataFrame, quantiles: dict = S.SEGMENT_QUANTILES) -> DataFrame:
    """Size, total and mean revenue and mean order count of the quantile segments.

    The totals per customer are kept on shared storage: the quantiles and the segments both read them.
    """
    n = F.count(F.lit(1))
    return (
        with_quantile_segment(settled(customer_totals(lines)), quantiles)
        .groupBy("segment")
        .agg(
            n.alias("customer_count"),
            F.sum("total_revenue").alias("total_revenue"),
            E.mean(F.sum("total_revenue"), n).alias("avg_revenue_per_customer"),
            E.mean(F.sum("order_frequency"), n).alias("avg_order_frequency"),
        )
    )
