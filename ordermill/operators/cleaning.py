"""Projections, filters and the cleaning chains. Everything here is stateless and works on
batch and streaming frames alike, except ``trim_p99`` which needs the whole table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.functions.quantiles import quantile_columns


def valid_sales(df: DataFrame, require_date: bool = True) -> DataFrame:
    """Lines with a positive quantity and price, a customer and (by default) a date."""
    keep = (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0) & F.col("CustomerID").isNotNull()
    if require_date:
        keep = keep & F.col("InvoiceDate").isNotNull()
    return df.where(keep)


def drop_any_null(df: DataFrame) -> DataFrame:
    """Lines with no null at all and a positive quantity and price."""
    return df.na.drop("any").transform(positive_lines)


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=S.CRITICAL_COLUMNS)


def positive_lines(df: DataFrame) -> DataFrame:
    return df.where((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))


def training_caps(df: DataFrame) -> DataFrame:
    """Training ignores lines over 100 units, over a price of 100, or without a country."""
    return df.where(
        (F.col("Quantity") <= 100) & (F.col("UnitPrice") <= 100) & F.col("Country").isNotNull()
    )


def p99_limits(df: DataFrame, fraction: float = 0.99) -> tuple[Column, Column]:
    """The quantity limit, and the price limit of the lines within it, as scalars.

    Both come from the counts of the pairs of quantity and price.
    """
    pairs = df.groupBy("Quantity", "UnitPrice").agg(F.count(F.lit(1)).alias("n"))
    quantity = quantile_columns(pairs, "Quantity", [fraction], "n")[0]
    price = quantile_columns(pairs.where(F.col("Quantity") <= quantity), "UnitPrice", [fraction], "n")[0]
    return quantity, price


def trim_p99(df: DataFrame, fraction: float = 0.99) -> DataFrame:
    """Drop quantities over their 99th percentile, then prices over that of the survivors."""
    quantity, price = p99_limits(df, fraction)
    return df.where((F.col("Quantity") <= quantity) & (F.col("UnitPrice") <= price))


def with_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("Revenue", E.revenue())


def with_time_parts(df: DataFrame) -> DataFrame:
    """Date, Hour, DayOfWeek (Monday is 0), Month and Year of ``InvoiceDate``."""
    date = F.col("InvoiceDate")
    return df.withColumns(
        {
            "Date": F.to_date(date),
            "Hour": F.hour(date),
            "DayOfWeek": F.weekday(date),
            "Month": F.month(date),
            "Year": F.year(date),
        }
    )


def with_calendar_flags(df: DataFrame, hour: str = "Hour", weekday: str = "DayOfWeek") -> DataFrame:
    return df.withColumns(
        {
            "IsWeekend": (F.col(weekday) >= 5).cast("int"),
            "IsBusinessHours": F.col(hour).between(9, 17).cast("int"),
        }
    )


def with_categories(df: DataFrame) -> DataFrame:
    """PriceCategory and QuantityCategory as the revenue model knows them."""
    return df.withColumns(
        {
            "PriceCategory": E.right_closed(F.col("UnitPrice"), S.PRICE_EDGES, S.PRICE_LABELS),
            "QuantityCategory": E.right_closed(F.col("Quantity"), S.QUANTITY_EDGES, S.QUANTITY_LABELS),
        }
    )


def with_ranges(df: DataFrame) -> DataFrame:
    """PriceRange and QuantityRange, the coarser bins of the prepared data set."""
    return df.withColumns(
        {
            "PriceRange": E.right_closed(F.col("UnitPrice"), S.PRICE_RANGE_EDGES, S.PRICE_LABELS),
            "QuantityRange": E.right_closed(F.col("Quantity"), S.QUANTITY_RANGE_EDGES, S.QUANTITY_LABELS),
        }
    )


def with_serving_categories(df: DataFrame, price: str = "unit_price", quantity: str = "quantity") -> DataFrame:
    """As ``with_categories``, but values at or under zero fall in the first bin."""
    return df.withColumns(
        {
            "PriceCategory": E.right_closed(F.col(price), S.PRICE_EDGES, S.PRICE_LABELS, True),
            "QuantityCategory": E.right_closed(F.col(quantity), S.QUANTITY_EDGES, S.QUANTITY_LABELS, True),
        }
    )


def fill_stream_defaults(df: DataFrame) -> DataFrame:
    return df.na.fill(
        {
            "CustomerID": S.ANONYMOUS_CUSTOMER,
            "Description": S.UNKNOWN_PRODUCT,
            "Country": S.UNKNOWN,
        }
    )


def normalise_description(df: DataFrame) -> DataFrame:
    text = F.coalesce("Description", F.lit(S.UNKNOWN_PRODUCT))
    return df.withColumn("Description", F.upper(F.trim(text)))


def standardise_country(df: DataFrame) -> DataFrame:
    trimmed = F.trim("Country")
    names = F.create_map(*[F.lit(x) for pair in S.COUNTRY_NAMES.items() for x in pair])
    return df.withColumn("Country", F.coalesce(F.try_element_at(names, trimmed), trimmed))


def parse_invoice_date(df: DataFrame, column: str = "InvoiceDate", strict: bool = True) -> DataFrame:
    """Text to timestamp. Bad text fails the job, or with ``strict=False`` drops the line."""
    if strict:
        return df.withColumn("InvoiceDate", F.to_timestamp(column))
    return df.withColumn("InvoiceDate", F.try_to_timestamp(column)).where(F.col("InvoiceDate").isNotNull())


def truncate_text(df: DataFrame, column: str, length: int = 50) -> DataFrame:
    """First ``length`` characters; empty or missing text becomes Unknown."""
    text = F.when(F.length(column) > 0, F.substring(column, 1, length))
    return df.withColumn(column, F.coalesce(text, F.lit(S.UNKNOWN)))


def clean_for_ml(df: DataFrame, aggressive: bool = False) -> DataFrame:
    kept = df.transform(drop_critical_nulls).transform(positive_lines).transform(parse_invoice_date)
    if aggressive:
        kept = trim_p99(kept)
    return (
        kept.transform(normalise_description)
        .transform(standardise_country)
        .transform(with_revenue)
        .transform(with_time_parts)
    )


def clean_for_streaming(df: DataFrame, date_column: str = "InvoiceDate") -> DataFrame:
    """Light cleaning that keeps lines without customer, description or country."""
    return (
        df.na.drop(subset=["Quantity", "UnitPrice"])
        .transform(positive_lines)
        .transform(fill_stream_defaults)
        .transform(parse_invoice_date, date_column, strict=False)
    )


def clean_for_schedule(df: DataFrame) -> DataFrame:
    """Cleaning of the scheduled job: everything its KPIs and its model read."""
    return (
        df.transform(drop_critical_nulls)
        .transform(positive_lines)
        .transform(parse_invoice_date)
        .transform(with_revenue)
        .transform(with_time_parts)
        .transform(with_calendar_flags)
        .transform(normalise_description)
        .transform(standardise_country)
        .transform(with_categories)
    )
