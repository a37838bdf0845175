"""Features, forecast, scoring and models. Values are checked with the mean-price model, whose
arithmetic SQL can repeat; queries on the random forest are checked for rows."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from checks.base import ROW_KEY, bins, half_up, lines, mean_cents, query, raw, with_lines
from checks.quality import CATEGORIES, FLAGS, TRIMMED
from checks.sources import CAPPED
from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.operators import features, forecast, kpi, model, scoring
from ordermill.plans.scheduled import run_scheduled
from ordermill.session import fresh_path, settled
from checks.warehouse import scoring_requests

START = "2024-03-01"

# Labelled lines that the scheduled job trains on: the operator's documented bound, lower than its default.
LABELLED = 5000

NUMBERS = f"Quantity, cast(UnitPrice as double) as UnitPrice, Hour, DayOfWeek, Month, {FLAGS}"


def code(column: str) -> str:
    return f"dense_rank() over (order by coalesce({column}, 'nan')) - 1 as {column}_encoded"


def codes(columns: list) -> str:
    return ", ".join(code(c) for c in columns)


BINNED = f"binned as (select *, {CATEGORIES} from lines)"

PRICED = f"""{BINNED},
prices as (select PriceCategory, (200 * sum(price_cents) + count(*)) // (2 * count(*)) as p4
  from binned group by PriceCategory),
scored as (select b.*, p4 * Quantity as pred4, abs(cents * 100 - p4 * Quantity) as err4
  from binned b join prices using (PriceCategory)),
records as (select *, (pred4 + 50) // 100 as pred, (err4 + 50) // 100 as err,
  {half_up("100 * (100 * cents - err4)", "100 * cents")} as accuracy from scored)"""

ACCURACY = "cast(round(accuracy * 100) as bigint)"


def fitted(spark, folder):
    """Lines and the mean-price model fitted on them."""
    sold = lines(spark, folder)
    return sold, scoring.MeanPriceModel.fit(sold)


@query("weekday_hour_patterns", with_lines("""
select DayOfWeek, Hour, cast(sum(cents) as double) / 100 / count(*) as avg_revenue, count(InvoiceNo) as orders,
  cast(sum(Quantity) as double) / count(*) as avg_quantity, cast(sum(price_cents) as double) / 100 / count(*) as avg_price
from lines group by DayOfWeek, Hour"""))
def weekday_hour_patterns(spark, folder):
    """F1."""
    return forecast.weekday_hour_patterns(lines(spark, folder, "InvoiceNo"))


PATTERNS = f"""patterns as (select DayOfWeek, Hour, cast(sum(cents) as double) / 100 / count(*) as revenue,
  count(*) as orders, cast(sum(Quantity) as double) / count(*) as quantity,
  cast(sum(price_cents) as double) / 100 / count(*) as price from lines group by DayOfWeek, Hour),
calendar as (select cast(unnest(range(date '{START}', date '{START}' + interval 7 day, interval 1 day)) as date) as date),
coming as (select date, isodow(date) - 1 as day_of_week, dayname(date) as day_name, sum(revenue) as revenue,
  sum(orders) as orders, cast(floor(avg(quantity)) as bigint) as quantity, avg(price) as price
  from calendar join patterns on DayOfWeek = isodow(date) - 1 group by date)"""


@query("revenue_forecast", f"""{with_lines('')}, {PATTERNS}
select cast(date as varchar) as date, day_of_week, day_name, round(revenue, 2) as historical_revenue,
  'medium' as confidence from coming""")
def revenue_forecast(spark, folder):
    """F2, J2, P18."""
    return forecast.revenue_forecast(lines(spark, folder, "InvoiceNo"), START)


@query("forecast_with_model", f"""{with_lines('')}, {PRICED}, {PATTERNS},
noon as (select c.*, {bins('price', S.PRICE_EDGES, S.PRICE_LABELS, True)} as PriceCategory from coming c)
select cast(date as varchar) as date, day_of_week, day_name, round(revenue, 2) as historical_revenue,
  {half_up("((p4 * quantity + 50) // 100) * orders", "10000")} as ml_predicted_revenue, 'high' as confidence
from noon join prices using (PriceCategory)""")
def forecast_with_model(spark, folder):
    """F3 with the mean-price model."""
    sold, mean_price = fitted(spark, folder)
    return forecast.forecast_with_model(sold, START, mean_price)


RECORDS = """select InvoiceNo as invoice_no, cast(cents as double) / 100 as actual_revenue,
  cast(pred as double) / 100 as predicted_revenue, cast(err as double) / 100 as prediction_error,
  accuracy as prediction_accuracy, true as answered from records"""


@query("prediction_records", f"{with_lines('')}, {PRICED} {RECORDS}")
def prediction_records(spark, folder):
    """F4, J6 for every line."""
    sold, mean_price = fitted(spark, folder)
    return scoring.prediction_records(scoring.enrich_with_prediction(sold, mean_price))


def summary(where: str) -> str:
    return f"""{with_lines('')}, {PRICED}
    select count(*) as total_predictions_attempted, count(*) as successful_predictions,
      100.0::double as prediction_success_rate, {half_up("sum(err)", "100 * count(*)")} as average_prediction_error,
      {half_up(f"sum({ACCURACY})", "100 * count(*)")} as average_prediction_accuracy,
      cast(sum(pred) as double) / 100 as total_predicted_revenue,
      cast(sum(cents) as double) / 100 as total_actual_revenue, cast(null as varchar) as error
    from records where {where}"""


@query("prediction_summary", summary("true"))
def prediction_summary(spark, folder):
    """F5 over every line."""
    sold, mean_price = fitted(spark, folder)
    scored = scoring.enrich_with_prediction(sold, mean_price)
    return scoring.prediction_summary(scoring.prediction_records(scored))


@query("prediction_summary_day", summary("Date = (select max(Date) from lines)"))
def prediction_summary_day(spark, folder):
    """F5 of the latest date, all of its lines."""
    sold, mean_price = fitted(spark, folder)
    scored = scoring.enrich_with_prediction(kpi.on_date(sold), mean_price)
    return scoring.prediction_summary(scoring.prediction_records(scored))


BAND = """case when cents <= 1000 then 'low' when cents <= 5000 then 'medium'
  when cents <= 10000 then 'high' else 'very_high' end"""


@query("performance_by_revenue_range", f"""{with_lines('')}, {PRICED}
select coalesce(band, 'overall') as revenue_range, count(*) as count,
  {half_up(f"sum({ACCURACY})", "100 * count(*)")} as avg_accuracy, min(accuracy) as min_accuracy,
  max(accuracy) as max_accuracy
from (select *, {BAND} as band from records) group by rollup (band)""")
def performance_by_revenue_range(spark, folder):
    """F6."""
    sold, mean_price = fitted(spark, folder)
    scored = scoring.enrich_with_prediction(sold, mean_price)
    return scoring.performance_by_revenue_range(scoring.prediction_records(scored))


@query("revenue_difference", f"""{with_lines('')}, {PRICED}
select cast(sum(pred) - sum(cents) as double) / 100 as revenue_difference,
  {half_up("100 * (sum(pred) - sum(cents))", "sum(cents)")} as revenue_difference_pct from records""")
def revenue_difference(spark, folder):
    """F7."""
    sold, mean_price = fitted(spark, folder)
    scored = scoring.enrich_with_prediction(sold, mean_price)
    return scoring.revenue_difference(scoring.prediction_records(scored))


@query("session_accuracy", f"""{with_lines('')}, {PRICED}
select cast(sum(pred) as double) / 100 as total_predicted, cast(sum(cents) as double) / 100 as total_actual,
  count(*) filter (pred > 10000) as high_value_alerts,
  {half_up("100 * (sum(cents) - abs(sum(pred) - sum(cents)))", "sum(cents)")} as accuracy from records""")
def session_accuracy(spark, folder):
    """F8."""
    sold, mean_price = fitted(spark, folder)
    return scoring.session_accuracy(scoring.enrich_with_prediction(sold, mean_price))


@query("label_dictionary", f"{with_lines('')}, {BINNED} " + " union all ".join(
    f"""select '{c}' as feature, category, row_number() over (order by category) - 1 as code
    from (select distinct coalesce({c}, 'nan') as category from binned)""" for c in S.CATEGORY_FEATURES))
def label_dictionary(spark, folder):
    """M1, W5."""
    sold = features.model_columns(lines(spark, folder, "Country"))
    return features.label_dictionary(sold, S.CATEGORY_FEATURES)


@query("label_encoded", f"""{with_lines('')}, {BINNED},
dictionary as (select category, row_number() over (order by category) - 1 as code
  from (select distinct coalesce(Country, 'nan') as category from binned where Month <= 6 and Country <> 'US'))
select Country, coalesce(code, 0) as Country_encoded, count(*) as n
from binned left join dictionary on category = Country group by all""")
def label_encoded(spark, folder):
    """Codes of a dictionary that does not know every country."""
    sold = lines(spark, folder, "Country")
    known = sold.where((F.col("Month") <= 6) & (F.col("Country") != "US"))
    encoded = features.label_encode(sold, features.label_dictionary(known, ["Country"]), ["Country"])
    return encoded.groupBy("Country", "Country_encoded").agg(kpi.rows().alias("n"))


SIDE = f"(cast(('0x' || substr({ROW_KEY}, 1, 8)) as bigint) % 100 < 80)"


@query("train_test_split", with_lines(f"""
select case when {SIDE} then 'train' else 'test' end as side, count(*) as samples,
  cast(min(cents) as double) / 100 as min_revenue, cast(max(cents) as double) / 100 as max_revenue,
  {mean_cents()} as avg_revenue from lines group by 1"""))
def train_test_split(spark, folder):
    """M3 with the target statistics of M11."""
    train, test = features.train_test_split(lines(spark, folder))
    sides = [features.target_summary(part).withColumn("side", F.lit(name)) for part, name in ((train, "train"), (test, "test"))]
    return sides[0].unionByName(sides[1])


@query("train_features", f"""{with_lines('')},
sample as (select * from lines where {CAPPED} order by {ROW_KEY} limit 50000),
binned as (select *, {CATEGORIES} from sample)
select {NUMBERS}, {codes(S.CATEGORY_FEATURES)}, cast(cents as double) / 100 as Revenue, {ROW_KEY} as row_key
from binned""")
def train_features(spark, folder):
    """M12, P20, S4, P5, P8, P9, P10, M1."""
    return features.train_features(raw(spark, folder))[0]


RANGES = f"""{bins('UnitPrice', S.PRICE_RANGE_EDGES, S.PRICE_LABELS)} as PriceRange,
  {bins('Quantity', S.QUANTITY_RANGE_EDGES, S.QUANTITY_LABELS)} as QuantityRange"""
PREPARED = S.NUMERIC_FEATURES + features.RANGE_ENCODED


def scaled(c: str) -> str:
    deviation = f"case when stddev_pop({c}) filter (train) over () > 0 then stddev_pop({c}) filter (train) over () else 1 end"
    return f"round(({c} - avg({c}) filter (train) over ()) / {deviation}, 6) + 0.0 as {c}"


@query("prepare_ml_dataset", f"""{with_lines('')}, {TRIMMED},
binned as (select *, {RANGES}, {SIDE} as train, {ROW_KEY} as row_key from trimmed),
encoded as (select {NUMBERS}, {codes(S.RANGE_FEATURES)}, cast(cents as double) / 100 as Revenue, row_key, train from binned)
select {', '.join(scaled(c) for c in PREPARED)}, Revenue, row_key,
  case when train then 'train' else 'test' end as side from encoded""")
def prepare_ml_dataset(spark, folder):
    """M11 of P3, P4, P6, P7, P8, P9, P11, M1, M2, M3."""
    train, test, _ = features.prepare_ml_dataset(raw(spark, folder))
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.withColumns({c: F.round(c, 6) + 0.0 for c in PREPARED})


@query("regression_metrics", f"""{with_lines('')}, {PRICED},
pairs as (select case when {SIDE} then 'train' else 'test' end as side, cast(cents as double) / 100 as y,
  cast(pred4 as double) / 10000 as p from scored)
select side, round(avg((y - p) * (y - p)), 2) as mse, round(sqrt(avg((y - p) * (y - p))), 4) as rmse,
  round(avg(abs(y - p)), 4) as mae, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) as r2_score, count(*) as samples
from pairs group by side""")
def regression_metrics(spark, folder):
    """M6 on both sides of the split."""
    sold, mean_price = fitted(spark, folder)
    side = F.when(E.key_number(E.row_key()) % 100 < 80, "train").otherwise("test")
    scored = scoring.enrich_with_prediction(sold, mean_price).withColumn("side", side)
    judged = scoring.regression_metrics(scored, by=("side",))
    digits = {"mse": 2, "rmse": 4, "mae": 4, "r2_score": 6}
    return judged.withColumns({c: F.round(c, d) for c, d in digits.items()})


REQUESTS = f"""requests as (select Quantity as quantity, cast(UnitPrice as double) as unit_price,
  coalesce(case when CustomerID % 5 <> 0 then Hour end, 14) as hour, DayOfWeek as day_of_week, Month as month,
  coalesce(case when CustomerID % 7 <> 0 then Country end, 'United Kingdom') as country from lines),
binned_requests as (select *, {bins('unit_price', S.PRICE_EDGES, S.PRICE_LABELS, True)} as price_category,
  {bins('quantity', S.QUANTITY_EDGES, S.QUANTITY_LABELS, True)} as quantity_category,
  cast(day_of_week >= 5 as bigint) as is_weekend, cast(hour between 9 and 17 as bigint) as is_business_hours from requests)"""


@query("score_orders", f"""{with_lines('')}, {PRICED}, {REQUESTS}
select r.*, cast((p4 * quantity + 50) // 100 as double) / 100 as predicted_revenue
from binned_requests r join prices on PriceCategory = price_category""")
def score_orders(spark, folder):
    """M8, P9, P12, P19 with the mean-price model."""
    sold, mean_price = fitted(spark, folder)
    return scoring.score_orders(scoring_requests(sold), mean_price).drop("prediction")


@query("batch_requests", with_lines("""select Quantity as quantity, cast(UnitPrice as double) as unit_price,
  coalesce(case when CustomerID % 5 <> 0 then Hour end, 12) as hour, DayOfWeek as day_of_week, InvoiceNo as invoice from lines"""))
def batch_requests(spark, folder):
    """P19 of the batch job: its own defaults, month and country left to the scorer."""
    asked = scoring_requests(lines(spark, folder), "InvoiceNo").drop("month", "country")
    return scoring.request_defaults(asked, S.BATCH_REQUEST_DEFAULTS).withColumnRenamed("InvoiceNo", "invoice")


@query("score_simple", f"""{with_lines('')}, {PRICED}
select Quantity as quantity, cast(UnitPrice as double) as unit_price,
  cast((p4 * Quantity + 50) // 100 as double) / 100 as predicted_revenue, cast(cents as double) / 100 as actual_revenue
from lines, (select p4 from prices where PriceCategory = 'Medium')""")
def score_simple(spark, folder):
    """M9 with the mean-price model: the category is Medium whatever the price."""
    sold, mean_price = fitted(spark, folder)
    return scoring.score_simple(scoring_requests(sold), mean_price)


@query("score_samples", f"""{with_lines('')}, {PRICED}
select InvoiceNo, StockCode, Quantity, cast(UnitPrice as double) as UnitPrice, cast(pred as double) / 100 as predicted_revenue,
  cast(cents as double) / 100 as actual_revenue, cast(err as double) / 100 as difference from records""")
def score_samples(spark, folder):
    """M10 with the mean-price model, for every line."""
    sold, mean_price = fitted(spark, folder)
    return scoring.score_samples(sold, mean_price)


TRAINED = {}


def trained(spark, folder):
    """Forest of the default size, dictionary and both sides of the split, of every line within the training caps.

    Trained once per session and folder, and kept on disk: whichever forest query runs first pays for it.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in TRAINED:
        rows, dictionary = features.train_features(raw(spark, folder), None)
        rows = settled(rows)
        train, test = features.train_test_split(rows, key=F.col("row_key"))
        path = fresh_path(spark, "model")
        model.save_model(model.train_revenue_model(train), dictionary, path, "order lines")
        TRAINED[key] = path, train, test
    path, train, test = TRAINED[key]
    forest, dictionary, _ = model.load_model(spark, path)
    return forest, dictionary, train, test


@query("revenue_forest")
def revenue_forest(spark, folder):
    """Quality of the forest on both sides of the split."""
    forest, _, train, test = trained(spark, folder)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return scoring.regression_metrics(forest.transform(both), by=("side",))


@query("simple_forest")
def simple_forest(spark, folder):
    """M5: quality of the forest of quantity and price, trained on every line."""
    sides = lines(spark, folder).select("Quantity", "UnitPrice", "Revenue", features.in_train().alias("train"))
    # read several times, and always in the same order, which the draws of rows for each tree go by
    rows = sides.persist(StorageLevel.DISK_ONLY)
    try:
        forest = model.train_simple_model(rows.where("train"))
        test = rows.where("not train").withColumn("UnitPrice", F.col("UnitPrice").cast("double"))
        return settled(scoring.regression_metrics(forest.transform(test)))
    finally:
        rows.unpersist()


@query("feature_importance")
def feature_importance(spark, folder):
    """M7, O2."""
    return model.feature_importance(trained(spark, folder)[0], spark)


def judged(scored, column: str = "predicted_revenue"):
    """The forest's own number gives way to whether it is one that revenue can have."""
    return scored.withColumn(column, F.coalesce(F.col(column) > 0, F.lit(False)))


ASKED = ["quantity", "unit_price", "hour", "day_of_week", "month", "country", "price_category", "quantity_category", "is_weekend", "is_business_hours"]


@query("score_orders_forest")
def score_orders_forest(spark, folder):
    """M8, S13 with the forest: every request with its inputs as used, and the predicted revenue."""
    forest, dictionary, _, _ = trained(spark, folder)
    scored = scoring.score_orders(scoring_requests(lines(spark, folder)), forest, dictionary)
    return scored.select(*ASKED, "predicted_revenue")


@query("score_simple_forest")
def score_simple_forest(spark, folder):
    """M9 with the forest."""
    forest, dictionary, _, _ = trained(spark, folder)
    return scoring.score_simple(scoring_requests(lines(spark, folder)), forest, dictionary)


@query("score_samples_forest")
def score_samples_forest(spark, folder):
    """M10, J6 with the forest: predicted and actual revenue of every line, and their difference."""
    forest, dictionary, _, _ = trained(spark, folder)
    return scoring.score_samples(lines(spark, folder), forest, dictionary)


# The same rows with what SQL can tell of a prediction: that it is one that revenue can have.


@query("judged_orders_forest", f"""{with_lines('')}, {REQUESTS}
select quantity, unit_price, hour, day_of_week, month, country, price_category, quantity_category, is_weekend,
  is_business_hours, true as predicted_revenue from binned_requests""")
def judged_orders_forest(spark, folder):
    """M8 with the forest: every request with its inputs as used, and whether its prediction is above 0."""
    return judged(score_orders_forest(spark, folder))


@query("judged_simple_forest", with_lines("""select Quantity as quantity, cast(UnitPrice as double) as unit_price,
  true as predicted_revenue, cast(cents as double) / 100 as actual_revenue from lines"""))
def judged_simple_forest(spark, folder):
    """M9 with the forest: whether predictions are above 0."""
    return judged(score_simple_forest(spark, folder))


@query("judged_samples_forest", with_lines("""select InvoiceNo, StockCode, Quantity, cast(UnitPrice as double) as UnitPrice,
  true as predicted_revenue, cast(cents as double) / 100 as actual_revenue, true as fits from lines"""))
def judged_samples_forest(spark, folder):
    """M10 with the forest; ``fits``: the difference is that of prediction and revenue."""
    scored = score_samples_forest(spark, folder)
    gap = F.abs(F.col("difference") - F.abs(F.col("predicted_revenue") - F.col("actual_revenue")))
    return judged(scored.withColumn("fits", gap < 0.0101)).drop("difference")


@query("forecast_with_forest")
def forecast_with_forest(spark, folder):
    """F3 with the forest."""
    forest, dictionary, _, _ = trained(spark, folder)
    return forecast.forecast_with_model(lines(spark, folder), START, forest, dictionary)


@query("run_report", with_lines("""select 5 as total_tasks, case when count(*) > 0 then 4 else 0 end as successful_tasks,
  case when count(*) > 0 then 3 else 0 end as data_files_created,
  case when count(*) > 0 then 'success' else 'partial_success' end as overall_status from lines"""))
def run_report(spark, folder):
    """The scheduled job from raw lines to its report."""
    return run_scheduled(raw(spark, folder), fresh_path(spark, "scheduled"), sample_size=LABELLED)[1]
