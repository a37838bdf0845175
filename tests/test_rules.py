"""Edge rules of the operators on small hand-made frames."""

import datetime as dt
from decimal import Decimal

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.operators import cleaning, customers, features, forecast, kpi, metrics, products, quality, scoring


def line(invoice="1", product="A", text="thing", quantity=1, date="2024-01-01 10:00:00", price=1.0, customer=1, country="UK"):
    return (invoice, product, text, quantity, date, price, customer, country)


def test_bins_are_closed_on_the_right(spark):
    values = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.01, 2.0, 2.01, 5.0, 15.0, 15.01]], "v double")
    training = E.right_closed(F.col("v"), S.PRICE_EDGES, S.PRICE_LABELS)
    serving = E.right_closed(F.col("v"), S.PRICE_EDGES, S.PRICE_LABELS, open_below=True)
    got = [tuple(r) for r in values.select(training, serving).collect()]
    assert [t for t, _ in got] == [None, None, "Low", "Low", "Medium", "Medium", "High", "Premium"]
    assert [s for _, s in got] == ["Low", "Low", "Low", "Low", "Medium", "Medium", "High", "Premium"]


def test_weekday_starts_on_monday(orders):
    df = orders(line(date="2024-01-01 09:00:00"), line(date="2024-01-07 18:00:00"))
    got = df.transform(cleaning.with_time_parts).transform(cleaning.with_calendar_flags)
    named = got.withColumn("name", E.weekday_name(F.col("DayOfWeek")))
    assert rows(named, "DayOfWeek", "name", "IsWeekend", "IsBusinessHours") == [(0, "Monday", 0, 1), (6, "Sunday", 1, 0)]


def test_country_names_match_exactly_after_trimming(orders):
    df = orders(*[line(country=c) for c in [" USA ", "UK", "uk", "UNITED KINGDOM", "France ", None]])
    got = [r[0] for r in df.transform(cleaning.standardise_country).select("Country").collect()]
    assert got == ["United States", "United Kingdom", "uk", "United Kingdom", "France", None]


def test_description_is_filled_trimmed_and_upper(orders):
    df = orders(line(text="  red cup "), line(text=None)).transform(cleaning.normalise_description)
    assert rows(df, "Description") == [("RED CUP",), ("UNKNOWN PRODUCT",)]


def test_truncated_text(orders):
    df = orders(line(text="x" * 60), line(text=None), line(text=""))
    assert rows(df.transform(cleaning.truncate_text, "Description"), "Description") == [("Unknown",), ("Unknown",), ("x" * 50,)]


def test_lenient_dates_drop_and_strict_dates_fail(orders):
    df = orders(line(date="2024-01-01 10:00:00"), line(date="never"), line(date=None), dated=False)
    assert cleaning.parse_invoice_date(df, strict=False).count() == 1
    assert rows(quality.invalid_dates(df)) == [(2,)]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        cleaning.parse_invoice_date(df).collect()


def test_streaming_defaults(orders):
    df = orders(line(text=None, customer=None, country=None), line(quantity=0), line(price=None))
    got = cleaning.clean_for_streaming(df)
    assert rows(got, "Description", "CustomerID", "Country") == [("Unknown Product", 99999, "Unknown")]


def test_trim_recomputes_the_price_limit_on_survivors(orders):
    lines = [line(quantity=q, price=1 + q) for q in range(1, 100)] + [line(quantity=10000, price=5000)]
    kept = cleaning.trim_p99(orders(*lines))
    # The first limit is 199, so only the big line goes; the second then falls on 99.02.
    assert kept.agg(F.max("Quantity"), F.count("*")).first()[:] == (98, 98)


def test_growth(spark):
    def growth(*points):
        series = spark.createDataFrame([(i, Decimal(v)) for i, v in enumerate(points)], "t int, v decimal(18,2)")
        return kpi.growth_rate(series, "t", ["v"]).first()[0]

    assert growth("100", "50", "150") == Decimal("50.00")
    assert growth("200", "150") == Decimal("-25.00")
    assert growth("7") == 0
    assert growth("0", "5") is None


def test_tops_break_ties_by_key_and_skip_null_keys(orders):
    df = kpi.order_lines(
        orders(line(customer=10, price=5), line(customer=9, price=5), line(customer=3, price=9), line(customer=4, price=1, country=None))
    )
    assert [r["key"] for r in kpi.daily_top(df, "customer").orderBy("place").collect()] == ["3", "9", "10"]
    assert [r["Country"] for r in kpi.top_countries(df).collect()] == ["UK"]


def test_peak_hour_takes_the_earlier_hour_on_ties(orders):
    df = kpi.order_lines(orders(line(date="2024-01-01 15:00:00"), line(date="2024-01-01 08:00:00")))
    assert kpi.peak_hour(df).first()["peak_hour"] == 8


def test_no_lines_on_the_date_gives_no_row(orders):
    df = kpi.order_lines(orders(line()))
    assert kpi.daily_metrics(df, dt.date(2023, 1, 1)).count() == 0
    assert kpi.daily_metrics(df).count() == 1


def test_days_active_counts_whole_days(orders):
    df = kpi.order_lines(orders(line(date="2024-01-01 10:00:00"), line(date="2024-01-03 09:00:00")))
    assert customers.customer_lifetime(df).first()["days_active"] == 1


def test_fixed_segments_include_their_floor(orders):
    df = orders(*[line(customer=c, price=p) for c, p in [(1, 2000), (2, 1999.99), (3, 1000), (4, 200), (5, 199.99)]])
    got = {r["customer_segment"]: r["customer_count"] for r in customers.customer_segments_fixed(df).collect()}
    assert got == {"VIP": 1, "High Value": 2, "Medium Value": 1, "Low Value": 1}


def test_ten_simple_orders(orders):
    df = orders(*[line(product="ABC"[i % 3], quantity=i + 1, price=10 + 2 * i, customer=i) for i in range(10)])
    got = kpi.simple_metrics(df).first()
    assert (got["total_revenue"], got["unique_customers"], got["unique_products"]) == (Decimal("1210.00"), 10, 3)


def test_products_with_two_names(orders):
    df = orders(line(text="a"), line(text="b"), line(product="B", text="c"), line(product="B", text=None))
    assert rows(quality.inconsistent_products(df)) == [(1,)]
    assert rows(products.product_labels(df)) == [("A", "a"), ("B", "c")]


def test_duplicates_count_equal_nulls(orders):
    df = orders(line(text=None), line(text=None), line())
    assert rows(quality.duplicate_rows(df)) == [(3, 1, Decimal("33.33"))]


def test_cleaning_report_tags_the_first_failing_step(orders):
    df = orders(line(), line(customer=None, quantity=-1), line(quantity=0, price=0), line(price=0), line(text=None))
    got = {r["step"]: r["rows_affected"] for r in quality.cleaning_report(df).collect()}
    assert got == {"missing_critical": 1, "non_positive_quantity": 1, "non_positive_price": 1, "filled_description": 1}
    assert quality.cleaning_report(df).first()["retention_rate"] == Decimal("40.00")


def test_reports_on_empty_input(orders, spark):
    df = orders(line()).where("false")
    assert quality.cleaning_report(df).first()["retention_rate"] is None
    assert rows(quality.duplicate_rows(df)) == [(0, 0, None)]
    assert [r["threshold"] for r in quality.iqr_outliers(df).collect()] == [None, None]
    assert customers.customer_segments_quantile(kpi.order_lines(df)).count() == 0


def test_missing_labels_are_nan_and_unseen_labels_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    dictionary = features.label_dictionary(df, ["c"])
    assert rows(dictionary) == [("c", "a", 0), ("c", "b", 1), ("c", "nan", 2)]
    new = spark.createDataFrame([("z",), (None,), ("b",)], "c string")
    assert rows(features.label_encode(new, dictionary, ["c"])) == [("b", 1), ("z", 0), (None, 2)]


def test_many_labels_sort_across_initials(spark):
    words = [f"{a}{b}{n}" for a in "ab " for b in "xyZ" for n in range(4)] + ["a", ""]
    dictionary = features.label_dictionary(spark.createDataFrame([(w,) for w in words], "c string"), ["c"])
    codes = {r["category"]: r["code"] for r in dictionary.collect()}
    assert codes == {w: i for i, w in enumerate(sorted(words))}


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    stats = features.scaling(df, ["a", "b"])
    assert rows(features.standard_scale(df, stats, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0)]


def scored(orders, spark, *pairs):
    data = [(str(i), Decimal(str(a)), None if p is None else float(p)) for i, (a, p) in enumerate(pairs)]
    return spark.createDataFrame(data, "InvoiceNo string, Revenue decimal(18,2), prediction double")


def test_prediction_records(orders, spark):
    got = scoring.prediction_records(scored(orders, spark, (100, 90), (50, 0), (20, None), (10, 25)))
    picked = rows(got, "invoice_no", "predicted_revenue", "prediction_error", "prediction_accuracy")
    d = Decimal
    assert picked == [
        ("0", d("90.0000").quantize(d("0.01")), d("10.00"), d("90.00")),
        ("1", None, None, None),
        ("2", None, None, None),
        ("3", d("25.00"), d("15.00"), d("-50.00")),
    ]
    summary = scoring.prediction_summary(got).first()
    assert (summary["total_predictions_attempted"], summary["successful_predictions"]) == (4, 3)
    assert summary["average_prediction_accuracy"] == d("20.00")
    assert summary["total_actual_revenue"] == d("110.00")
    ranges = {r["revenue_range"]: r["count"] for r in scoring.performance_by_revenue_range(got).collect()}
    assert ranges == {"low": 1, "high": 1, "overall": 2}


def test_no_predictions_leave_a_note(orders, spark):
    got = scoring.prediction_summary(scoring.prediction_records(scored(orders, spark, (5, None)))).first()
    assert got["error"] == "No successful predictions"


def test_five_session_orders(orders, spark):
    orders_ = [(2, 19.99), (1, 45.0), (3, 8.75), (7, 6.5), (1, 125.0)]
    got = scoring.session_accuracy(scored(orders, spark, *[(round(q * p, 2), q * p) for q, p in orders_])).first()
    assert (got["total_actual"], got["accuracy"], got["high_value_alerts"]) == (Decimal("281.73"), Decimal("100.00"), 1)


def test_request_defaults(spark):
    got = scoring.request_defaults(spark.createDataFrame([(None, None)], "hour int, quantity int")).first()
    assert (got["quantity"], got["unit_price"], got["hour"], got["day_of_week"], got["month"], got["country"]) == (
        1, 10.0, 14, 2, 6, "United Kingdom")


def test_forecast_skips_weekdays_without_history(orders):
    monday = kpi.order_lines(orders(line(price=4), line(price=6), line(date="2024-01-01 11:00:00", price=3)))
    got = forecast.revenue_forecast(monday, "2024-03-01", 7).collect()
    assert [(str(r["date"]), r["day_name"], r["historical_revenue"]) for r in got] == [("2024-03-04", "Monday", 8.0)]


def test_levels(spark):
    df = spark.createDataFrame([("cpu", 95.0), ("cpu", 80.0), ("cpu", 79.9), ("api_response", 999.0), ("other", 96.0)], "metric string, value double")
    assert [r["status"] for r in metrics.status_level(df).collect()] == ["critical", "warning", "healthy", "healthy", "critical"]


def test_run_report_is_partial_when_a_stage_gave_nothing(spark):
    stages = spark.createDataFrame([("clean", 5, True), ("train", 0, False)], "stage string, rows bigint, file_created boolean")
    assert tuple(metrics.run_report(stages).first()) == (5, 1, 1, "partial_success")
