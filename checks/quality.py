"""Cleaning chains, derived columns and data-quality reports."""

from pyspark.sql import functions as F

from checks.base import (
    COUNTRY,
    DESCRIPTION,
    LINES,
    RAW,
    bins,
    half_up,
    mean_cents,
    quantile,
    query,
    raw,
    text,
    with_lines,
    with_raw,
)
from ordermill import schema as S
from ordermill.operators import cleaning, quality
from checks.warehouse import retail_text

COLUMNS = ", ".join(S.RAW_COLUMNS)
PRICE = "cast(UnitPrice as double) as UnitPrice"
DATE = f"{text('InvoiceDate')} as InvoiceDate"
PARTS = "cast(Date as varchar) as Date, Hour, DayOfWeek, Month, Year"
FLAGS = """cast(DayOfWeek >= 5 as bigint) as IsWeekend,
  cast(Hour between 9 and 17 as bigint) as IsBusinessHours"""
CATEGORIES = f"""{bins('UnitPrice', S.PRICE_EDGES, S.PRICE_LABELS)} as PriceCategory,
  {bins('Quantity', S.QUANTITY_EDGES, S.QUANTITY_LABELS)} as QuantityCategory"""
CLEAN = f"""InvoiceNo, StockCode, {DESCRIPTION} as Description, Quantity, {DATE}, {PRICE}, CustomerID,
  {COUNTRY} as Country, cast(cents as double) / 100 as Revenue, {PARTS}"""

# Quantities over their 99th percentile go first, then prices over that of the rest.
TRIMMED = """quantity_cut as (select quantile_cont(cast(Quantity as double), 0.99) as q from lines),
price_cut as (select quantile_cont(cast(UnitPrice as double), 0.99) as p from lines, quantity_cut where Quantity <= q),
trimmed as (select lines.* from lines, quantity_cut, price_cut
  where Quantity <= q and cast(UnitPrice as double) <= p)"""


@query("clean_for_ml", with_lines(f"select {CLEAN} from lines"))
def clean_for_ml(spark, folder):
    """P21 of P3, P4, P7, P8, P14, P15, P16."""
    return raw(spark, folder).transform(cleaning.clean_for_ml)


@query("clean_for_ml_aggressive", f"{with_lines('')}, {TRIMMED} select {CLEAN} from trimmed")
def clean_for_ml_aggressive(spark, folder):
    """P21 with P6."""
    return raw(spark, folder).transform(cleaning.clean_for_ml, aggressive=True)


TEXT = f"""{RAW}, retail_text as (select * replace (
  case when cast(InvoiceNo as bigint) % 173 = 0 then 'not a date' else {text('InvoiceDate')} end as InvoiceDate)
  from retail_raw)"""


@query("clean_for_streaming", f"""with {TEXT}
select InvoiceNo, StockCode, coalesce(Description, 'Unknown Product') as Description, Quantity,
  {text('try_cast(InvoiceDate as timestamp)')} as InvoiceDate, {PRICE}, coalesce(CustomerID, 99999) as CustomerID,
  coalesce(Country, 'Unknown') as Country
from retail_text where Quantity > 0 and UnitPrice > 0 and try_cast(InvoiceDate as timestamp) is not null""")
def clean_for_streaming(spark, folder):
    """P22 of P4, P13, P16 lenient."""
    dated = retail_text(spark, folder).drop("InvoiceDate")
    return cleaning.clean_for_streaming(dated, "InvoiceDateText").select(*S.RAW_COLUMNS)


@query("clean_for_schedule", with_lines(f"select {CLEAN}, {FLAGS}, {CATEGORIES} from lines"))
def clean_for_schedule(spark, folder):
    """P23 of P3, P4, P7, P8, P9, P10, P14, P15."""
    return raw(spark, folder).transform(cleaning.clean_for_schedule)


@query("category_counts", with_raw(f"""
select {CATEGORIES}, {bins('UnitPrice', S.PRICE_RANGE_EDGES, S.PRICE_LABELS)} as PriceRange,
  {bins('Quantity', S.QUANTITY_RANGE_EDGES, S.QUANTITY_LABELS)} as QuantityRange,
  {bins('UnitPrice', S.PRICE_EDGES, S.PRICE_LABELS, True)} as ServingPrice,
  {bins('Quantity', S.QUANTITY_EDGES, S.QUANTITY_LABELS, True)} as ServingQuantity, count(*) as n
from retail_raw group by all"""))
def category_counts(spark, folder):
    """P10, P11, P12 on all raw lines, those without a bin included."""
    binned = raw(spark, folder, "UnitPrice")
    serving = cleaning.with_serving_categories(binned, "UnitPrice", "Quantity").withColumnsRenamed(
        {"PriceCategory": "ServingPrice", "QuantityCategory": "ServingQuantity"}
    )
    both = serving.transform(cleaning.with_categories).transform(cleaning.with_ranges)
    keys = ["PriceCategory", "QuantityCategory", "PriceRange", "QuantityRange", "ServingPrice", "ServingQuantity"]
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("complete_lines", with_lines(f"select {COLUMNS.replace('InvoiceDate', DATE).replace('UnitPrice', PRICE)} "
                                    "from lines where Description is not null and Country is not null"))
def complete_lines(spark, folder):
    """P2."""
    return raw(spark, folder).transform(cleaning.drop_any_null)


@query("training_lines", with_lines(f"select {COLUMNS.replace('InvoiceDate', DATE).replace('UnitPrice', PRICE)} "
                                    "from lines where Quantity <= 100 and UnitPrice <= 100 and Country is not null"))
def training_lines(spark, folder):
    """P5 on P1."""
    return raw(spark, folder).transform(cleaning.valid_sales).transform(cleaning.training_caps)


TYPES = {"Quantity": "int", "InvoiceDate": "timestamp", "UnitPrice": "decimal(10,2)", "CustomerID": "bigint"}
PROFILE = " union all ".join(
    f"""select {i + 1} as position, '{c}' as column_name, '{TYPES.get(c, "string")}' as type,
    count(*) - count({c}) as null_count, {half_up(f"100 * (count(*) - count({c}))", "count(*)")} as null_pct
    from retail_raw"""
    for i, c in enumerate(S.RAW_COLUMNS)
)
DUPLICATES = f"""select cast(sum(n) as bigint) as total_rows, cast(sum(n - 1) as bigint) as duplicate_rows,
  {half_up("100 * sum(n - 1)", "sum(n)")} as duplicate_pct
from (select count(*) as n from retail_raw group by {COLUMNS})"""
INVALID = """select count(*) filter (Quantity < 0) as negative_quantity, count(*) filter (Quantity = 0) as zero_quantity,
  count(*) filter (UnitPrice < 0) as negative_price, count(*) filter (UnitPrice = 0) as zero_price from retail_raw"""
BAD_DATES = "select count(*) filter (try_cast(InvoiceDate as timestamp) is null) as invalid_dates from retail_text"
OUTLIERS = " union all ".join(
    f"""select '{c}' as column_name, q1, q3, q3 + 1.5::double * (q3 - q1) as threshold,
    count(*) filter (cast({c} as double) > q3 + 1.5::double * (q3 - q1)) as outliers,
    max(cast({c} as double)) as max_value
    from retail_raw, (select {quantile(c, 0.25)} as q1, {quantile(c, 0.75)} as q3 from retail_raw) group by q1, q3"""
    for c in ("Quantity", "UnitPrice")
)
INCONSISTENT = """select count(*) filter (names > 1) as products_with_multiple_descriptions
from (select StockCode, count(distinct Description) as names from retail_raw group by StockCode)"""


@query("column_profile", with_raw(PROFILE))
def column_profile(spark, folder):
    """Q1."""
    return quality.column_profile(raw(spark, folder))


@query("duplicate_rows", with_raw(DUPLICATES))
def duplicate_rows(spark, folder):
    """Q2."""
    return quality.duplicate_rows(raw(spark, folder))


@query("invalid_values", with_raw(INVALID))
def invalid_values(spark, folder):
    """Q3."""
    return quality.invalid_values(raw(spark, folder, "Quantity"))


@query("invalid_dates", f"with {TEXT} {BAD_DATES}")
def invalid_dates(spark, folder):
    """Q4, P16."""
    return quality.invalid_dates(retail_text(spark, folder, ["InvoiceNo"]), "InvoiceDateText")


@query("iqr_outliers", with_raw(OUTLIERS))
def iqr_outliers(spark, folder):
    """Q5, J3."""
    return quality.iqr_outliers(raw(spark, folder, "Quantity"))


@query("inconsistent_products", with_raw(INCONSISTENT))
def inconsistent_products(spark, folder):
    """Q6."""
    return quality.inconsistent_products(raw(spark, folder, "StockCode", "Description"))


def report(steps: dict, source: str, extra: str = "") -> str:
    """One row per step from the number of lines each step removes first."""
    tests, earlier = [], []
    for condition in steps.values():
        tests.append(" and ".join([f"coalesce({condition}, false)", *[f"not coalesce({e}, false)" for e in earlier]]))
        earlier.append(condition)
    kept = " and ".join(f"not coalesce({e}, false)" for e in earlier)
    rows = [f"({i + 1}, '{name}', count(*) filter ({t}))" for i, (name, t) in enumerate(zip(steps, tests))]
    rows.append(f"({len(steps) + 1}, 'filled_description', count(*) filter (Description is null and {kept}))")
    structs = ", ".join(
        f"{{'step_no': {r[1:-1].split(', ', 2)[0]}, 'step': {r[1:-1].split(', ', 2)[1]}, "
        f"'rows_affected': {r[1:-1].split(', ', 2)[2]}}}"
        for r in rows
    )
    return f"""select unnest([{structs}], recursive := true), initial_rows, final_rows,
      initial_rows - final_rows as rows_removed, {half_up("100 * final_rows", "initial_rows")} as retention_rate{extra}
      from (select *, count(*) over () as initial_rows, count(*) filter ({kept}) over () as final_rows from {source})
      group by initial_rows, final_rows"""


ML_STEPS = {
    "missing_critical": "CustomerID is null or InvoiceDate is null or Quantity is null or UnitPrice is null",
    "non_positive_quantity": "Quantity <= 0",
    "non_positive_price": "UnitPrice <= 0",
}
OUTLIER_STEPS = ML_STEPS | {
    "quantity_outlier": "Quantity > (select q from quantity_cut)",
    "price_outlier": "cast(UnitPrice as double) > (select p from price_cut)",
}
STREAM_STEPS = {
    "missing_amount": "Quantity is null or UnitPrice is null",
    "non_positive_quantity": "Quantity <= 0",
    "non_positive_price": "UnitPrice <= 0",
    "invalid_date": "try_cast(InvoiceDate as timestamp) is null",
}


@query("cleaning_report", with_raw(report(ML_STEPS, "retail_raw", ", false as aggressive")))
def cleaning_report(spark, folder):
    """Q7, P3, P4."""
    return quality.cleaning_report(raw(spark, folder, "Description"))


@query("cleaning_report_aggressive",
       f"with {LINES}, {TRIMMED} {report(OUTLIER_STEPS, 'retail_raw', ', true as aggressive')}")
def cleaning_report_aggressive(spark, folder):
    """Q7, P6."""
    return quality.cleaning_report(raw(spark, folder, "Description"), aggressive=True)


@query("streaming_cleaning_report", f"with {TEXT} {report(STREAM_STEPS, 'retail_text')}")
def streaming_cleaning_report(spark, folder):
    """Q7 of the streaming rules."""
    columns = ["InvoiceNo", "Description", "Quantity", "UnitPrice"]
    return quality.streaming_cleaning_report(retail_text(spark, folder, columns), "InvoiceDateText")


NUMERIC = ["Quantity", "UnitPrice", "CustomerID", "Revenue", "Hour", "DayOfWeek", "Month"]
DESCRIBED = f"""complete as (select *, cast(cents as double) / 100 as Revenue from lines
  where Description is not null and Country is not null)"""


def described(c: str) -> str:
    hundredths = {"UnitPrice": "price_cents", "Revenue": "cents"}.get(c, f"100 * {c}")
    return f"""select '{c}' as column_name, count({c}) as count, {mean_cents(f"sum({hundredths})", f"count({c})", 4)} as mean,
      round(stddev_samp(cast({c} as double)), 4) as std, cast(min({c}) as double) as min,
      {quantile(c, 0.25)} as p25, {quantile(c, 0.5)} as p50, {quantile(c, 0.75)} as p75,
      cast(max({c}) as double) as max from complete"""


@query("describe_numeric", f"{with_lines('')}, {DESCRIBED} {' union all '.join(described(c) for c in NUMERIC)}")
def describe_numeric(spark, folder):
    """Q8."""
    whole = raw(spark, folder).transform(cleaning.drop_any_null)
    return quality.describe_numeric(
        whole.transform(cleaning.with_revenue).transform(cleaning.with_time_parts), NUMERIC
    )


def long(section: str, frame: str, metrics: list, column: str = "null") -> str:
    return " union all ".join(
        f"select '{section}' as section, '{m}' as metric, cast({column} as varchar) as column_name, "
        f"cast({m} as double) as value from ({frame})"
        for m in metrics
    )


@query("quality_report", f"with {TEXT} " + " union all ".join([
    long("missing_values", f"select * from ({PROFILE}) where null_count > 0", ["null_count", "null_pct"], "column_name"),
    long("duplicates", DUPLICATES, ["duplicate_rows", "duplicate_pct"]),
    long("invalid_values", INVALID, ["negative_quantity", "zero_quantity", "negative_price", "zero_price"]),
    long("data_type_issues", BAD_DATES, ["invalid_dates"]),
    long("outliers", OUTLIERS, ["outliers", "threshold", "max_value"], "column_name"),
    long("inconsistencies", INCONSISTENT, ["products_with_multiple_descriptions"]),
]))
def quality_report(spark, folder):
    """Q9."""
    return quality.quality_report(retail_text(spark, folder), "InvoiceDateText")
