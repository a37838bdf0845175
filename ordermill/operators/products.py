"""Product metrics. Where any description of a product would do, it is the smallest one."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import expressions as E
from ordermill.functions.distinct import tallied, values_of
from ordermill.operators.cleaning import truncate_text, valid_sales, with_revenue


def product_performance(raw: DataFrame, n: int | None = 10) -> DataFrame:
    """Per product name, units, revenue, customers and invoices; best ``n`` by revenue or all."""
    lines = raw.transform(valid_sales, require_date=False).transform(with_revenue)
    names = ["Description", "CustomerID", "InvoiceNo"]
    products = (
        tallied(lines, ["StockCode"], names, {"Quantity": "sum", "Revenue": "sum"})
        .groupBy("StockCode")
        .agg(
            F.min(F.when(F.col("kind") == 0, F.col("value"))).alias("product_name"),
            F.sum("Quantity").alias("total_quantity_sold"),
            F.sum("Revenue").alias("total_revenue"),
            values_of(1).alias("unique_customers"),
            values_of(2).alias("total_orders"),
        )
        .transform(truncate_text, "product_name")
    )
    return products if n is None else products.orderBy(F.desc("total_revenue"), "StockCode").limit(n)


def product_labels(lines: DataFrame) -> DataFrame:
    return lines.groupBy("StockCode").agg(F.min("Description").alias("Description"))


def top_products_by_quantity(lines: DataFrame, n: int = 5) -> DataFrame:
    """Best ``n`` products by units, then a look-up of their names only."""
    units = lines.where(F.col("StockCode").isNotNull()).groupBy("StockCode")
    best = units.agg(F.sum("Quantity").alias("units")).orderBy(F.desc("units"), "StockCode").limit(n)
    named = lines.join(best.select("StockCode"), "StockCode", "left_semi")
    return best.join(product_labels(named), "StockCode", "left").transform(truncate_text, "Description", 30)


def first_products(raw: DataFrame, n: int | None = 200) -> DataFrame:
    """Product codes, the first ``n`` of them or all."""
    codes = raw.select("StockCode").where(F.col("StockCode").isNotNull()).distinct()
    return codes if n is None else codes.orderBy("StockCode").limit(n)


def price_patterns(raw: DataFrame, max_products: int | None = 200) -> DataFrame:
    """Lowest, highest and mean price of the first ``max_products`` products, or of all."""
    priced = raw.where(F.col("StockCode").isNotNull() & (F.col("UnitPrice") > 0))
    if max_products is not None:
        priced = priced.join(first_products(raw, max_products), "StockCode", "left_semi")
    return priced.groupBy("StockCode").agg(
        F.min("UnitPrice").alias("min_price"),
        F.max("UnitPrice").alias("max_price"),
        E.mean(F.sum("UnitPrice"), F.count("UnitPrice"), 4).alias("avg_price"),
        F.min("Description").alias("description"),
    )


def distinct_values(raw: DataFrame, max_products: int | None = None) -> DataFrame:
    """All product codes, or the first ``max_products``, and all countries as rows ``kind, value``."""
    products = first_products(raw, max_products).select(F.lit("product").alias("kind"), F.col("StockCode").alias("value"))
    countries = raw.select(F.lit("country").alias("kind"), F.col("Country").alias("value"))
    return products.unionByName(countries.where(F.col("value").isNotNull()).distinct())
