"""Reports that combine several operators."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import expressions as E
from ordermill.operators.cleaning import valid_sales
from ordermill.operators.customers import customer_segments_fixed
from ordermill.operators.kpi import daily_trends
from ordermill.operators.products import product_performance
from ordermill.session import settled


READ = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID"]


def _read_once(raw: DataFrame) -> DataFrame:
    """Valid sales with the columns the sections need, kept on shared storage so that ``raw`` is read once."""
    return settled(raw.select(*READ).transform(valid_sales, require_date=False))


def analytics_report(raw: DataFrame) -> DataFrame:
    """Newest days, customer segments and best products as one table.

    The key is text and every measure a double, so days, segments and products align; measures
    a section does not have are null.
    """

    raw = _read_once(raw)

    def section(name: str, frame: DataFrame, key: str, measures: dict) -> DataFrame:
        values = [F.col(column).cast("double").alias(measure) for measure, column in measures.items()]
        return frame.select(F.lit(name).alias("section"), F.col(key).cast("string").alias("key"), *values)

    days = section(
        "daily_trends",
        daily_trends(raw),
        "order_date",
        {
            "revenue": "total_revenue",
            "orders": "total_orders",
            "customers": "unique_customers",
            "products": "unique_products",
            "avg_value": "avg_order_value",
        },
    )
    segments = section(
        "customer_segments",
        customer_segments_fixed(raw),
        "customer_segment",
        {"customers": "customer_count", "avg_value": "avg_revenue", "avg_frequency": "avg_order_frequency"},
    )
    products = section(
        "top_products",
        product_performance(raw),
        "StockCode",
        {
            "revenue": "total_revenue",
            "orders": "total_orders",
            "customers": "unique_customers",
            "quantity": "total_quantity_sold",
        },
    )
    return days.unionByName(segments, True).unionByName(products, True)


def analytics_summary(raw: DataFrame) -> DataFrame:
    """How much the report analysed, and revenue and orders of its days."""
    raw = _read_once(raw)
    n = F.count(F.lit(1))
    segments = customer_segments_fixed(raw).agg(n).scalar()
    products = product_performance(raw).agg(n).scalar()
    days = daily_trends(raw).agg(
        n.alias("total_days_analyzed"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        E.mean(F.sum("total_revenue"), n).alias("average_daily_revenue"),
    )
    return days.withColumns(
        {"customer_segments_identified": segments, "top_products_analyzed": products}
    )
