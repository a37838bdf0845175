"""Score requests and order lines with a model, and judge the predictions.

A model is anything with ``transform(df)`` that adds a ``prediction`` column: a fitted
``PipelineModel`` or the ``MeanPriceModel`` below.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.operators import cleaning as C
from ordermill.operators.features import label_encode, model_columns


class MeanPriceModel:
    """Predicts mean price of the price category times quantity. The model is at most five numbers."""

    def __init__(self, prices: dict):
        self.prices = prices

    @classmethod
    def fit(cls, lines: DataFrame) -> "MeanPriceModel":
        price = E.mean(F.sum("UnitPrice"), F.count("UnitPrice"), 4).cast("decimal(14,4)")
        means = lines.transform(C.with_categories).groupBy("PriceCategory").agg(price.alias("price"))
        return cls({r["PriceCategory"]: r["price"] for r in means.collect()})

    def transform(self, df: DataFrame) -> DataFrame:
        price = F.lit(None).cast("decimal(14,4)")
        for category, mean in self.prices.items():
            price = F.when(F.col("PriceCategory") == category, F.lit(mean).cast("decimal(14,4)")).otherwise(price)
        return df.withColumn("prediction", (price * F.col("Quantity")).cast("decimal(18,4)"))


def request_defaults(requests: DataFrame, defaults: dict = S.REQUEST_DEFAULTS) -> DataFrame:
    """Fill missing request fields; fields the requests lack altogether are added."""
    filled = {}
    for name, default in defaults.items():
        known = F.col(name) if name in requests.columns else F.lit(None)
        filled[name] = F.coalesce(known, F.lit(default))
    return requests.withColumns(filled)


FEATURE_OF = {
    "quantity": "Quantity",
    "unit_price": "UnitPrice",
    "hour": "Hour",
    "day_of_week": "DayOfWeek",
    "month": "Month",
    "country": "Country",
}
ECHO_OF = {name: request for request, name in FEATURE_OF.items()} | {
    "PriceCategory": "price_category",
    "QuantityCategory": "quantity_category",
    "IsWeekend": "is_weekend",
    "IsBusinessHours": "is_business_hours",
}


def request_features(requests: DataFrame) -> DataFrame:
    """Requests with defaults, categories and flags under the names the models read."""
    return (
        request_defaults(requests)
        .transform(C.with_serving_categories)
        .withColumnsRenamed(FEATURE_OF)
        .transform(C.with_calendar_flags)
    )


def score_orders(requests: DataFrame, model, encoders: DataFrame | None = None) -> DataFrame:
    """Requests with their inputs as used, categories, flags and ``predicted_revenue``."""
    ready = request_features(requests)
    if encoders is not None:
        ready = label_encode(ready, encoders, S.CATEGORY_FEATURES)
    scored = model.transform(ready).withColumn("predicted_revenue", F.round("prediction", 2))
    return scored.withColumnsRenamed(ECHO_OF)


def simple_features(requests: DataFrame) -> DataFrame:
    """Quantity and price as given; every other feature fixed, the categories included."""
    fixed = {
        "Hour": 14,
        "DayOfWeek": 2,
        "Month": 6,
        "Country": "United Kingdom",
        "PriceCategory": "Medium",
        "QuantityCategory": "Few",
        "IsWeekend": 0,
        "IsBusinessHours": 1,
    }
    given = requests.select(F.col("quantity").alias("Quantity"), F.col("unit_price").alias("UnitPrice"))
    return given.withColumns({name: F.lit(value) for name, value in fixed.items()})


def score_simple(requests: DataFrame, model, encoders: DataFrame | None = None) -> DataFrame:
    """Predicted and actual revenue of requests that only give quantity and price."""
    ready = simple_features(requests)
    if encoders is not None:
        ready = label_encode(ready, encoders, S.CATEGORY_FEATURES)
    return model.transform(ready).select(
        F.col("Quantity").alias("quantity"),
        F.col("UnitPrice").alias("unit_price"),
        F.round("prediction", 2).alias("predicted_revenue"),
        F.round(F.col("Quantity") * F.col("UnitPrice"), 2).alias("actual_revenue"),
    )


def enrich_with_prediction(lines: DataFrame, model, encoders: DataFrame | None = None) -> DataFrame:
    """Order lines with the prediction for each of them."""
    ready = model_columns(lines)
    if encoders is not None:
        ready = label_encode(ready, encoders, S.CATEGORY_FEATURES)
    return model.transform(ready)


def score_samples(lines: DataFrame, model, encoders: DataFrame | None = None) -> DataFrame:
    """Predicted, actual and absolute difference of given lines."""
    scored = enrich_with_prediction(lines, model, encoders)
    predicted = F.round("prediction", 2)
    return scored.select(
        "InvoiceNo",
        "StockCode",
        "Quantity",
        "UnitPrice",
        predicted.alias("predicted_revenue"),
        F.col("Revenue").alias("actual_revenue"),
        F.round(F.abs(F.col("prediction") - F.col("Revenue")), 2).alias("difference"),
    )


def prediction_records(scored: DataFrame) -> DataFrame:
    """Actual, predicted, error and accuracy per line; nulls where there is no prediction or 0."""
    actual = F.col("Revenue")
    predicted = F.col("prediction").cast("decimal(18,4)")
    given = F.when(predicted != 0, predicted)
    error = F.abs(actual - given).cast("decimal(18,4)")
    accuracy = F.when(actual > 0, F.round(F.try_divide(actual - error, actual) * 100, 2))
    return scored.select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.round(actual, 2).alias("actual_revenue"),
        F.round(given, 2).alias("predicted_revenue"),
        F.round(error, 2).alias("prediction_error"),
        accuracy.cast("decimal(18,2)").alias("prediction_accuracy"),
        F.col("prediction").isNotNull().alias("answered"),
    )


def prediction_summary(records: DataFrame) -> DataFrame:
    """Success rate, mean error and accuracy, and totals over the lines with a prediction."""
    valid = F.col("predicted_revenue").isNotNull()
    n, answered = F.count(F.lit(1)), F.count_if("answered")
    accuracy = F.col("prediction_accuracy")
    return records.agg(
        n.alias("total_predictions_attempted"),
        answered.alias("successful_predictions"),
        E.percent(answered, n).alias("prediction_success_rate"),
        E.mean(F.sum("prediction_error"), F.count("prediction_error")).alias("average_prediction_error"),
        E.mean(F.sum(accuracy), F.count(accuracy)).alias("average_prediction_accuracy"),
        F.sum("predicted_revenue").alias("total_predicted_revenue"),
        F.sum(F.when(valid, F.col("actual_revenue"))).alias("total_actual_revenue"),
        F.when(F.count_if(valid) == 0, "No successful predictions").alias("error"),
    )


def revenue_band(actual: Column) -> Column:
    return (
        F.when(actual <= 10, "low")
        .when(actual <= 50, "medium")
        .when(actual <= 100, "high")
        .otherwise("very_high")
    )


def performance_by_revenue_range(records: DataFrame) -> DataFrame:
    """Accuracy per band of actual revenue, and over all bands in the row ``overall``.

    The overall row is made of the four bands, not of the records again.
    """
    accuracy = F.col("prediction_accuracy")
    bands = (
        records.groupBy(revenue_band(F.col("actual_revenue")).alias("revenue_range"))
        .agg(
            F.count(accuracy).alias("n"),
            F.sum(accuracy).alias("total"),
            F.min(accuracy).alias("low"),
            F.max(accuracy).alias("high"),
        )
        .where(F.col("n") > 0)
    )
    return (
        bands.rollup("revenue_range")
        .agg(
            F.sum("n").alias("count"),
            E.mean(F.sum("total"), F.sum("n")).alias("avg_accuracy"),
            F.min("low").alias("min_accuracy"),
            F.max("high").alias("max_accuracy"),
        )
        .where(F.col("count").isNotNull())
        .withColumn("revenue_range", F.coalesce("revenue_range", F.lit("overall")))
    )


def revenue_difference(records: DataFrame) -> DataFrame:
    """Predicted minus actual revenue, and as a percentage of the actual (0 without any)."""
    summary = prediction_summary(records)
    predicted, actual = F.col("total_predicted_revenue"), F.col("total_actual_revenue")
    difference = predicted - actual
    return summary.select(
        difference.alias("revenue_difference"),
        F.when(actual > 0, E.percent(difference, actual)).otherwise(0).alias("revenue_difference_pct"),
    )


def session_accuracy(scored: DataFrame, limit: float = S.HIGH_VALUE_REVENUE) -> DataFrame:
    """Totals of a scored session, accuracy of the totals, and alerts on the prediction."""
    given = scored.where(F.col("prediction").isNotNull())
    predicted = F.round(F.col("prediction").cast("decimal(18,4)"), 2)
    totals = given.agg(
        F.sum(predicted).alias("total_predicted"),
        F.sum("Revenue").alias("total_actual"),
        F.count_if(predicted > limit).alias("high_value_alerts"),
    )
    gap = F.abs(F.col("total_predicted") - F.col("total_actual"))
    return totals.withColumn("accuracy", E.percent(F.col("total_actual") - gap, F.col("total_actual")))


def regression_metrics(scored: DataFrame, label: str = "Revenue", by: tuple = ()) -> DataFrame:
    """Mean squared and absolute error, root, R2 and row count, per ``by`` group if given."""
    y, p = F.col(label).cast("double"), F.col("prediction").cast("double")
    squares = F.avg((y - p) * (y - p))
    return scored.groupBy(*by).agg(
        squares.alias("mse"),
        F.sqrt(squares).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(squares, F.var_pop(y))).alias("r2_score"),
        F.count(F.lit(1)).alias("samples"),
    )
