"""Business metrics over order lines: daily, weekly, by hour, weekday and country.

``lines`` is the output of ``order_lines``: valid sales with Revenue and time parts.
"Orders" counts lines, as the metric has always been defined.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.functions.bitmaps import bitmaps, counted, merged
from ordermill.functions.distinct import tallied, values_of
from ordermill.functions.quantiles import quantile_columns
from ordermill.operators.cleaning import valid_sales, with_revenue, with_time_parts

DAY_DIMENSIONS = {
    "hour": "Hour",
    "customer": "CustomerID",
    "product": "StockCode",
    "country": "Country",
}


def order_lines(raw: DataFrame, require_date: bool = True) -> DataFrame:
    return raw.transform(valid_sales, require_date).transform(with_revenue).transform(with_time_parts)


def rows() -> Column:
    return F.count(F.lit(1))


def total_revenue() -> Column:
    return F.sum("Revenue")


def mean_revenue() -> Column:
    return E.mean(F.sum("Revenue"), F.count("Revenue"))


def latest_day(lines: DataFrame, before: int = 0) -> Column:
    """The beginning of the latest date with lines, or of a date some days ``before`` it, as a scalar.

    It is a timestamp, so that a bound on ``InvoiceDate`` by it reaches the scan.
    """
    return lines.agg(F.date_sub(F.to_date(F.max("InvoiceDate")), before).cast("timestamp")).scalar()


def on_date(lines: DataFrame, target_date=None) -> DataFrame:
    """Lines of one date, by default the latest one."""
    if target_date is None:
        return lines.where(F.col("InvoiceDate") >= latest_day(lines))
    day = F.lit(target_date).cast("date")
    bounds = (F.col("InvoiceDate") >= day.cast("timestamp")) & (F.col("InvoiceDate") < F.date_add(day, 1).cast("timestamp"))
    # for tables with a folder for each date
    return lines.where(bounds & (F.col("Date") == day) if "Date" in lines.columns else bounds)


def daily_breakdown(lines: DataFrame, top: int = 3, dimensions: dict = DAY_DIMENSIONS) -> DataFrame:
    """Best ``top`` hours, customers, products and countries of every date by revenue.

    All dimensions share one scan and one shuffle; at most ``top`` rows per date, dimension
    and input partition reach the ranking.
    """
    cells = [
        F.struct(F.lit(name).alias("dimension"), F.col(column).cast("string").alias("key"))
        for name, column in dimensions.items()
    ]
    sums = (
        lines.select("Date", "Revenue", F.inline(F.array(*cells)))
        .where(F.col("key").isNotNull())
        .groupBy("Date", "dimension", "key")
        .agg(total_revenue().alias("revenue"))
    )
    best = Window.partitionBy("Date", "dimension").orderBy(F.desc("revenue"), *E.ranked_key())
    return sums.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)


def daily_top(lines: DataFrame, dimension: str, top: int = 3, target_date=None) -> DataFrame:
    """Best customers, products or countries of one date."""
    column = {dimension: DAY_DIMENSIONS[dimension]}
    return daily_breakdown(on_date(lines, target_date), top, column)


def top_per_date(lines: DataFrame, dimension: str = "customer", top: int = 3) -> DataFrame:
    """``daily_top`` for every date at once."""
    return daily_breakdown(lines, top, {dimension: DAY_DIMENSIONS[dimension]})


def peak_hour(lines: DataFrame, by: tuple = ("Date",)) -> DataFrame:
    """Hour with the highest revenue; the earlier hour on ties."""
    hourly = lines.groupBy(*by, "Hour").agg(total_revenue().alias("revenue"))
    best = F.max_by("Hour", F.struct("revenue", -F.col("Hour")))
    return hourly.groupBy(*by).agg(
        best.alias("peak_hour"), F.max("revenue").alias("peak_hour_revenue")
    )


def counts_and_totals() -> list[Column]:
    """Measures of a date's lines."""
    return [
        rows().alias("total_orders"),
        total_revenue().alias("total_revenue"),
        F.count_distinct("CustomerID").alias("unique_customers"),
        F.count_distinct("StockCode").alias("unique_products"),
        mean_revenue().alias("avg_order_value"),
        F.sum("Quantity").alias("total_quantity"),
        F.count_distinct("Country").alias("countries_served"),
    ]


def daily_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("Date").agg(*counts_and_totals())


def daily_metrics_by_date(lines: DataFrame) -> DataFrame:
    """``daily_counts`` with the peak hour of every date.

    Sums, hours and countries come from one small table by date, hour and country; customers and products, of which
    there are many, are counted apart, so that no sum goes along with them.
    """
    hourly = lines.groupBy("Date", "Hour", "Country").agg(
        rows().alias("n"), total_revenue().alias("revenue"), F.count("Revenue").alias("priced"), F.sum("Quantity").alias("quantity")
    )
    hours = hourly.groupBy("Date", "Hour").agg(
        F.sum("n").alias("n"),
        F.sum("revenue").alias("revenue"),
        F.sum("priced").alias("priced"),
        F.sum("quantity").alias("quantity"),
        F.collect_set("Country").alias("countries"),
    )
    best = F.max_by("Hour", F.struct("revenue", -F.col("Hour")))
    days = hours.groupBy("Date").agg(
        F.sum("n").alias("total_orders"),
        F.sum("revenue").alias("total_revenue"),
        E.mean(F.sum("revenue"), F.sum("priced")).alias("avg_order_value"),
        F.sum("quantity").alias("total_quantity"),
        F.size(F.array_distinct(F.flatten(F.collect_list("countries")))).cast("bigint").alias("countries_served"),
        best.alias("peak_hour"),
        F.max("revenue").alias("peak_hour_revenue"),
    )
    distinct = lines.groupBy("Date").agg(
        F.count_distinct("CustomerID").alias("unique_customers"), F.count_distinct("StockCode").alias("unique_products")
    )
    return days.join(distinct, "Date")


def daily_customers(lines: DataFrame) -> DataFrame:
    """``Date, bucket, bits``: the customers of every date as bitmaps, a small table that can be kept and added to."""
    return bitmaps(lines, ["Date"], "CustomerID")


def customers_by_period(daily: DataFrame) -> DataFrame:
    """``period, start, unique_customers`` of every week, month and year, put together from ``daily_customers``."""
    periods = [F.struct(F.lit(p).alias("period"), F.trunc("Date", p).alias("start")) for p in ("week", "month", "year")]
    spread = daily.select("bucket", "bits", F.inline(F.array(*periods)))
    return merged(spread, ["period", "start"]).transform(counted, ["period", "start"], "unique_customers")


def day_metrics(lines: DataFrame) -> DataFrame:
    """The same from one read, for the lines of one date: the revenue of each hour is one more sum."""
    hours = [F.struct(F.sum(F.when(F.col("Hour") == h, F.col("Revenue"))).alias("revenue"), F.lit(-h).alias("hour")) for h in range(24)]
    best = F.array_max(F.filter(F.array(*hours), lambda h: h["revenue"].isNotNull()))
    daily = lines.groupBy("Date").agg(*counts_and_totals(), best.alias("best"))
    return daily.select("*", (-F.col("best.hour")).alias("peak_hour"), F.col("best.revenue").alias("peak_hour_revenue")).drop("best")


def daily_metrics(lines: DataFrame, target_date=None) -> DataFrame:
    """Metrics of one date, by default the latest; no row when it has no lines."""
    return day_metrics(on_date(lines, target_date))


def daily_document(lines: DataFrame, target_date=None) -> DataFrame:
    """``daily_metrics`` with arrays of the best three customers, products and countries."""
    day = on_date(lines, target_date)

    def best(dimension: str, key: Column, name: str) -> Column:
        entry = F.struct("place", key.alias(name), F.col("revenue").alias("revenue"))
        ranked = F.sort_array(F.collect_list(F.when(F.col("dimension") == dimension, entry)))
        return F.transform(ranked, lambda e: F.struct(e[name].alias(name), e["revenue"].alias("revenue")))

    customers, products, countries = [{d: DAY_DIMENSIONS[d]} for d in ("customer", "product", "country")]
    tops = (
        daily_breakdown(day, dimensions=customers | products | countries)
        .groupBy("Date")
        .agg(
            best("customer", F.col("key").cast("bigint"), "customer_id").alias("top_customers"),
            best("product", F.col("key"), "product_code").alias("top_products"),
            best("country", F.col("key"), "country").alias("top_countries"),
        )
    )
    return day_metrics(day).join(tops, "Date")


def daily_trends(raw: DataFrame, days: int | None = 7) -> DataFrame:
    """Per date lines, revenue, customers, products and mean; the newest ``days`` dates or all.

    The newest dates are found first, by the lines of each date, so that the distinct counts only see their lines.
    """
    lines = raw.transform(valid_sales, require_date=False).withColumn("order_date", F.to_date("InvoiceDate"))
    if days is not None:
        dates = lines.where(F.col("InvoiceDate").isNotNull()).groupBy("order_date").agg(F.lit(1))
        newest = dates.orderBy(F.desc("order_date")).limit(days)
        lines = lines.where(F.col("InvoiceDate") >= newest.agg(F.min("order_date").cast("timestamp")).scalar())
    return lines.transform(with_revenue).groupBy("order_date").agg(
        rows().alias("total_orders"),
        total_revenue().alias("total_revenue"),
        F.count_distinct("CustomerID").alias("unique_customers"),
        F.count_distinct("StockCode").alias("unique_products"),
        mean_revenue().alias("avg_order_value"),
    )


def last_days(lines: DataFrame, days: int = 7) -> DataFrame:
    """Lines of the ``days`` calendar days that end at the latest date."""
    return lines.where(F.col("InvoiceDate") >= latest_day(lines, days - 1))


def weekly_trends(lines: DataFrame) -> DataFrame:
    """Per date of the last seven calendar days; days without lines are not filled in."""
    return last_days(lines).groupBy("Date").agg(
        total_revenue().alias("revenue"),
        F.count("InvoiceNo").alias("orders"),
        F.count_distinct("CustomerID").alias("customers"),
    )


def growth(column: str, time: str) -> Column:
    """Change of a measure from the first to the last point of a series in percent; 0 for fewer than two points."""
    first, last = F.min_by(column, time), F.max_by(column, time)
    return F.when(rows() < 2, F.lit(0).cast(change_type())).otherwise(E.percent((last - first), first))


def growth_rate(series: DataFrame, time: str, columns: list[str]) -> DataFrame:
    return series.agg(*[growth(c, time).alias(f"{c}_growth") for c in columns])


def change_type() -> str:
    return "decimal(38,2)"


def weekly_total(lines: DataFrame) -> DataFrame:
    """Bounds and revenue of the last week with its revenue and order growth."""
    return weekly_trends(lines).agg(
        F.date_sub(F.max("Date"), 6).alias("week_start"),
        F.max("Date").alias("week_end"),
        F.sum("revenue").alias("total_weekly_revenue"),
        growth("revenue", "Date").alias("revenue_growth"),
        growth("orders", "Date").alias("orders_growth"),
    )


def rolling_revenue(lines: DataFrame, days: int = 7) -> DataFrame:
    """Revenue of the ``days`` calendar days up to each date. Windows run over daily sums only."""
    daily = lines.groupBy("Date").agg(total_revenue().alias("revenue"))
    trailing = Window.orderBy(F.unix_date("Date")).rangeBetween(-(days - 1), 0)
    return daily.withColumn("trailing_revenue", F.sum("revenue").over(trailing))


def growth_by(lines: DataFrame, key: str, period: str = "month") -> DataFrame:
    """Growth of every ``key`` from its first to its last period by revenue; a period is one of a certain year."""
    sums = lines.groupBy(key, F.trunc("Date", period).alias("period")).agg(total_revenue().alias("revenue"))
    return sums.groupBy(key).agg(rows().alias("periods"), growth("revenue", "period").alias("revenue_growth"))


def business_metrics(lines: DataFrame) -> DataFrame:
    """Totals and distinct counts over all lines.

    Each line's date carries the sums; the other distinct values go without.
    """
    one = lines.select(
        "Date", "Country", "StockCode", "CustomerID", F.lit(1).alias("n"), "Revenue", F.when(F.col("Revenue").isNotNull(), 1).alias("priced"),
        F.col("InvoiceDate").alias("first"), F.col("InvoiceDate").alias("last"),
    )
    each = tallied(
        one, [], ["Date", "Country", "StockCode", "CustomerID"], {"n": "sum", "Revenue": "sum", "priced": "sum", "first": "min", "last": "max"}
    )
    n, days = F.coalesce(F.sum("n"), F.lit(0)), values_of(0)
    return each.agg(
        n.alias("total_transactions"),
        F.sum("Revenue").alias("total_revenue"),
        E.mean(F.sum("Revenue"), F.sum("priced")).alias("avg_order_value"),
        values_of(3).alias("unique_customers"),
        values_of(2).alias("unique_products"),
        values_of(1).alias("countries_served"),
        F.timestamp_diff("DAY", F.min("first"), F.max("last")).alias("date_range_days"),
        E.mean(n, days).alias("avg_daily_transactions"),
        F.least(F.lit(10000), F.floor(n / 100)).alias("recommended_batch_size"),
    )


def top_countries(lines: DataFrame, n: int = 5) -> DataFrame:
    sums = lines.where(F.col("Country").isNotNull()).groupBy("Country")
    return sums.agg(total_revenue().alias("revenue")).orderBy(F.desc("revenue"), "Country").limit(n)


def hourly_revenue(lines: DataFrame) -> DataFrame:
    return lines.groupBy("Hour").agg(total_revenue().alias("revenue"))


def peak_hour_overall(lines: DataFrame) -> DataFrame:
    return hourly_revenue(lines).orderBy(F.desc("revenue"), "Hour").limit(1)


def weekday_revenue(lines: DataFrame) -> DataFrame:
    sums = lines.groupBy("DayOfWeek").agg(total_revenue().alias("revenue"))
    return sums.withColumn("day_name", E.weekday_name(F.col("DayOfWeek")))


def peak_weekday(lines: DataFrame) -> DataFrame:
    return weekday_revenue(lines).orderBy(F.desc("revenue"), "DayOfWeek").limit(1)


def order_batch_summary(lines: DataFrame) -> DataFrame:
    """Totals, ranges and the exact median of a batch of orders."""
    median = quantile_columns(lines, "Revenue", [0.5])[0]
    summary = lines.agg(
        rows().alias("total_orders"),
        total_revenue().alias("total_revenue"),
        mean_revenue().alias("avg_order_value"),
        F.count_distinct("StockCode").alias("unique_products"),
        F.count_distinct("CustomerID").alias("unique_customers"),
        F.count_distinct("Country").alias("unique_countries"),
        F.min("Revenue").alias("min_revenue"),
        F.max("Revenue").alias("max_revenue"),
        F.min("Quantity").alias("min_quantity"),
        F.max("Quantity").alias("max_quantity"),
        E.mean(F.sum("Quantity"), F.count("Quantity")).alias("avg_quantity"),
    )
    return summary.withColumn("median_revenue", median)


def simple_metrics(raw: DataFrame) -> DataFrame:
    """Five totals over all lines, without any cleaning."""
    return raw.transform(with_revenue).agg(
        rows().alias("total_orders"),
        total_revenue().alias("total_revenue"),
        mean_revenue().alias("avg_order_value"),
        F.count_distinct("CustomerID").alias("unique_customers"),
        F.count_distinct("StockCode").alias("unique_products"),
    )


def revenue_range(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.min("Revenue").alias("min_revenue"),
        F.max("Revenue").alias("max_revenue"),
        mean_revenue().alias("mean_revenue"),
    )


def assign_mix(df: DataFrame, key: Column, shares: dict = S.ORDER_MIX, name: str = "order_type") -> DataFrame:
    """Deal rows into the given shares by their hashed key: the first share whose running sum
    reaches the key's place in [0, 1). Rows beyond the last running sum take the first share."""
    place = E.key_number(key) / float(1 << 32)
    pick, until = F, 0.0
    for label, share in shares.items():
        until += share
        pick = pick.when(place <= until, label)
    return df.withColumn(name, pick.otherwise(next(iter(shares))))
