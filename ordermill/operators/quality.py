"""Data-quality profile and cleaning reports."""

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.functions.quantiles import quantile_row, scale_of, value_counts
from ordermill.operators.cleaning import drop_critical_nulls, p99_limits, positive_lines
from ordermill.session import settled


def _null_counts(df: DataFrame) -> list:
    return [F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema)]


def _profile_cells(df: DataFrame) -> list:
    return [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("null_count"),
            E.percent(F.col(f"n{i}"), F.col("rows")).alias("null_pct"),
        )
        for i, f in enumerate(df.schema)
    ]


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, number and percentage of nulls."""
    once = df.agg(F.count(F.lit(1)).alias("rows"), *_null_counts(df))
    return once.select(F.inline(F.array(*_profile_cells(df))))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row (nulls are equal), and their percentage."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return copies.agg(
        total.alias("total_rows"),
        extra.alias("duplicate_rows"),
        E.percent(extra, total).alias("duplicate_pct"),
    )


def _invalid_counts() -> list:
    return [
        F.count_if(F.col("Quantity") < 0).alias("negative_quantity"),
        F.count_if(F.col("Quantity") == 0).alias("zero_quantity"),
        F.count_if(F.col("UnitPrice") < 0).alias("negative_price"),
        F.count_if(F.col("UnitPrice") == 0).alias("zero_price"),
    ]


def invalid_values(df: DataFrame) -> DataFrame:
    return df.agg(*_invalid_counts())


def _invalid_dates(column: str):
    return F.count_if(F.try_to_timestamp(column).isNull()).alias("invalid_dates")


def invalid_dates(df: DataFrame, column: str = "InvoiceDate") -> DataFrame:
    """Dates that cannot be parsed, missing ones included."""
    return df.agg(_invalid_dates(column))


def iqr_outliers(df: DataFrame, columns: tuple = ("Quantity", "UnitPrice")) -> DataFrame:
    """Per column: quartiles, Q3 + 1.5 IQR, values above it, and the maximum.

    ``df`` is read once, into the counts of its values, which everything else comes from.
    """
    counts = value_counts(df, list(columns))
    quartiles = quantile_row(df, list(columns), [0.25, 0.75], counts=counts).select(F.struct("*")).scalar()
    counts, cells = counts.withColumn("quartiles", quartiles), []
    for c in columns:
        q1, q3 = [F.col("quartiles")[c][k] for k in range(2)]
        limit = q3 + 1.5 * (q3 - q1)
        own = F.when(F.col("name") == c, F.col("v") / F.lit(float(10 ** scale_of(df, c))))
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.max(q1).alias("q1"),
                F.max(q3).alias("q3"),
                F.max(limit).alias("threshold"),
                F.coalesce(F.sum(F.when(own > limit, F.col("n"))), F.lit(0)).alias("outliers"),
                F.max(own).alias("max_value"),
            )
        )
    return counts.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def inconsistent_products(df: DataFrame) -> DataFrame:
    """Products that carry more than one description."""
    per_product = df.groupBy("StockCode").agg(F.count_distinct("Description").alias("names"))
    named = per_product.where(F.col("StockCode").isNotNull())
    return named.agg(F.count_if(F.col("names") > 1).alias("products_with_multiple_descriptions"))


def copies_and_names(df: DataFrame) -> DataFrame:
    """``duplicate_rows`` and ``inconsistent_products`` in one row, from one read: equal rows are counted first, then
    rows, copies and descriptions of each product."""
    equal = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    products = equal.groupBy("StockCode").agg(
        F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("extra"), F.count_distinct("Description").alias("names")
    )
    total, extra = [F.coalesce(F.sum(c), F.lit(0)) for c in ("rows", "extra")]
    return products.agg(
        extra.alias("duplicate_rows"),
        E.percent(extra, total).alias("duplicate_pct"),
        F.count_if(F.col("StockCode").isNotNull() & (F.col("names") > 1)).alias("products_with_multiple_descriptions"),
    )


def cleaning_steps(df: DataFrame, aggressive: bool = False) -> list:
    """Ordered ``(step, condition under which a line is removed there)`` of ``clean_for_ml``."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in S.CRITICAL_COLUMNS])
    steps = [
        ("missing_critical", missing),
        ("non_positive_quantity", F.col("Quantity") <= 0),
        ("non_positive_price", F.col("UnitPrice") <= 0),
    ]
    if aggressive:
        kept = df.transform(drop_critical_nulls).transform(positive_lines)
        quantity, price = p99_limits(kept)
        steps += [
            ("quantity_outlier", F.col("Quantity") > quantity),
            ("price_outlier", F.col("UnitPrice") > price),
        ]
    return steps


def streaming_steps(date_column: str = "InvoiceDate") -> list:
    """The same for ``clean_for_streaming``."""
    return [
        ("missing_amount", F.col("Quantity").isNull() | F.col("UnitPrice").isNull()),
        ("non_positive_quantity", F.col("Quantity") <= 0),
        ("non_positive_price", F.col("UnitPrice") <= 0),
        ("invalid_date", F.try_to_timestamp(date_column).isNull()),
    ]


def first_failed_step(steps: list):
    failed = F.lit(None).cast("string")
    for name, condition in reversed(steps):
        failed = F.when(condition, name).otherwise(failed)
    return failed


def _report(df: DataFrame, steps: list) -> DataFrame:
    tagged = df.withColumn("_step", first_failed_step(steps))
    once = tagged.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(F.col("_step").isNull()).alias("final_rows"),
        F.count_if(F.col("_step").isNull() & F.col("Description").isNull()).alias("filled"),
        *[F.count_if(F.col("_step") == name).alias(name) for name, _ in steps],
    )
    rows = [(name, F.col(name)) for name, _ in steps] + [("filled_description", F.col("filled"))]
    cells = [
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(name).alias("step"), n.alias("rows_affected"))
        for i, (name, n) in enumerate(rows)
    ]
    return once.select(
        F.inline(F.array(*cells)),
        "initial_rows",
        "final_rows",
        (F.col("initial_rows") - F.col("final_rows")).alias("rows_removed"),
        E.percent(F.col("final_rows"), F.col("initial_rows")).alias("retention_rate"),
    )


def cleaning_report(df: DataFrame, aggressive: bool = False) -> DataFrame:
    """Per step of ``clean_for_ml``: lines it removed (or filled), with the overall retention."""
    return _report(df, cleaning_steps(df, aggressive)).withColumn("aggressive", F.lit(aggressive))


def streaming_cleaning_report(df: DataFrame, date_column: str = "InvoiceDate") -> DataFrame:
    return _report(df, streaming_steps(date_column))


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while another action runs, without a scan of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of each column, one row per column.

    ``df`` is read once, into the counts of its values, which everything comes from; sums and squares are exact.
    """
    counts = value_counts(df, columns)
    quartiles = quantile_row(df, columns, [0.25, 0.5, 0.75], counts=counts).select(F.struct("*")).scalar()
    counts, cells = counts.withColumn("quartiles", quartiles), []
    for c in columns:
        scale = 10 ** scale_of(df, c)
        own = lambda value, c=c: F.when(F.col("name") == c, value)
        v, n = F.col("v").cast("decimal(20,0)"), F.col("n").cast("decimal(12,0)")
        size = F.coalesce(F.sum(own(F.col("n"))), F.lit(0))
        total, squares = F.sum(own(v * n)), F.sum(own((v * v).cast("decimal(26,0)") * n))
        spread = squares.cast("double") - total.cast("double") * total.cast("double") / size
        p25, p50, p75 = [F.max(F.col("quartiles")[c][k]) for k in range(3)]
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                size.alias("count"),
                E.mean(total / scale, size, 4).cast("double").alias("mean"),
                F.when(size > 1, F.round(F.sqrt(F.greatest(spread, F.lit(0.0)) / (size - 1)) / scale, 4)).alias("std"),
                (F.min(own(F.col("v"))) / scale).alias("min"),
                p25.alias("p25"),
                p50.alias("p50"),
                p75.alias("p75"),
                (F.max(own(F.col("v"))) / scale).alias("max"),
            )
        )
    return counts.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def quality_report(df: DataFrame, date_column: str = "InvoiceDate") -> DataFrame:
    """All checks as rows ``section, metric, column_name, value``, from three reads of ``df``."""

    def long(section: str, frame: DataFrame, metrics: list[str], column=None) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        column = F.lit(None).cast("string") if column is None else F.col(column)
        wide = frame.select(column.alias("column_name"), F.inline(F.array(*cells)))
        return wide.select(F.lit(section).alias("section"), "metric", "column_name", "value")

    raw = df.select(*S.RAW_COLUMNS)
    once = df.agg(F.count(F.lit(1)).alias("rows"), *_null_counts(raw), *_invalid_counts(), _invalid_dates(date_column))
    # each of these is a row or two, and everything below reads them instead of the lines
    once, copies = settled(once), settled(copies_and_names(raw))
    profile = once.select(F.inline(F.array(*_profile_cells(raw))))
    parts = [
        long("missing_values", profile.where("null_count > 0"), ["null_count", "null_pct"], "column_name"),
        long("duplicates", copies, ["duplicate_rows", "duplicate_pct"]),
        long("invalid_values", once, ["negative_quantity", "zero_quantity", "negative_price", "zero_price"]),
        long("data_type_issues", once, ["invalid_dates"]),
        long("outliers", iqr_outliers(raw), ["outliers", "threshold", "max_value"], "column_name"),
        long("inconsistencies", copies, ["products_with_multiple_descriptions"]),
    ]
    return reduce(DataFrame.unionByName, parts)
