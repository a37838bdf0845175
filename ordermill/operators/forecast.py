"""Revenue forecast from weekday and hour patterns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import expressions as E
from ordermill.operators.scoring import score_orders


def weekday_hour_patterns(lines: DataFrame) -> DataFrame:
    """Mean revenue, lines, mean quantity and mean price per weekday and hour: at most 168 rows.

    Money is summed exactly before the division.
    """
    return lines.groupBy("DayOfWeek", "Hour").agg(
        (F.sum("Revenue").cast("double") / F.count("Revenue")).alias("avg_revenue"),
        F.count("InvoiceNo").alias("orders"),
        F.avg("Quantity").alias("avg_quantity"),
        (F.sum("UnitPrice").cast("double") / F.count("UnitPrice")).alias("avg_price"),
    )


def forecast_days(lines: DataFrame, start_date: str, days: int) -> DataFrame:
    """Patterns of every coming date; a date whose weekday has none is left out."""
    first = F.lit(start_date).cast("date")
    calendar = lines.sparkSession.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("date"))
    calendar = calendar.withColumn("DayOfWeek", F.weekday("date"))
    patterns = weekday_hour_patterns(lines).groupBy("DayOfWeek").agg(
        F.sum("avg_revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        F.avg("avg_quantity").alias("quantity"),
        F.avg("avg_price").alias("price"),
    )
    return calendar.join(F.broadcast(patterns), "DayOfWeek")


def revenue_forecast(lines: DataFrame, start_date: str, days: int = 7) -> DataFrame:
    """Historical revenue of the coming dates: the sum over hours of the mean line revenue."""
    return forecast_days(lines, start_date, days).select(
        "date",
        F.col("DayOfWeek").alias("day_of_week"),
        E.weekday_name(F.col("DayOfWeek")).alias("day_name"),
        F.round("revenue", 2).alias("historical_revenue"),
        F.lit("medium").alias("confidence"),
    )


def forecast_with_model(lines: DataFrame, start_date: str, model, encoders: DataFrame | None = None, days: int = 7) -> DataFrame:
    """The forecast with the model's price for a representative noon order of each date.

    The predicted revenue scales with the expected lines, divided by 100. Where the model
    gives nothing or 0, the historical figure stands with medium confidence.
    """
    requests = forecast_days(lines, start_date, days).select(
        "date",
        "orders",
        "revenue",
        F.col("DayOfWeek").alias("day_of_week"),
        F.floor("quantity").cast("int").alias("quantity"),
        F.col("price").alias("unit_price"),
        F.lit(12).alias("hour"),
    )
    scored = score_orders(requests, model, encoders)
    found = F.col("predicted_revenue") != 0
    return scored.select(
        "date",
        "day_of_week",
        E.weekday_name(F.col("day_of_week")).alias("day_name"),
        F.round("revenue", 2).alias("historical_revenue"),
        F.when(found, F.round(F.col("predicted_revenue") * F.col("orders") / 100, 2))
        .otherwise(0.0)
        .alias("ml_predicted_revenue"),
        F.when(found, "high").otherwise("medium").alias("confidence"),
    )
