"""Plans: what is pushed down, read once, and kept off Python and cross joins."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES
from ordermill.functions.quantiles import quantile_row
from ordermill.operators import cleaning, customers, kpi, products, quality
from ordermill.plans import reports
from ordermill.session import fresh_path
from checks.warehouse import retail_raw

LAZY = [
    "daily_trends",
    "daily_metrics_by_date",
    "daily_document",
    "weekly_total",
    "customer_segments_fixed",
    "customer_lifetime",
    "product_performance_all",
    "business_metrics",
    "clean_for_schedule",
    "duplicate_rows",
    "cleaning_report",
    "training_sample",
    "revenue_forecast",
    "score_orders",
    "matched_orders_by_user",
    "littles_law",
    "session_report",
    "windowed_revenue",
]


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.fixture(scope="module")
def stored(spark, small):
    """Order lines as a table of their own."""
    path = fresh_path(spark, "plan-lines")
    retail_raw(spark, small).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(kpi.daily_trends(stored))
    assert "GreaterThan(Quantity,0)" in text and "GreaterThan(UnitPrice,0.00)" in text and "IsNotNull(CustomerID)" in text
    assert "Description" not in text and "Country" not in text


@pytest.mark.parametrize("report", [kpi.daily_metrics, kpi.daily_document, kpi.weekly_trends, kpi.weekly_total])
def test_the_latest_date_reaches_the_scan(stored, report):
    assert "GreaterThanOrEqual(InvoiceDate,ScalarSubquery" in plan(report(kpi.order_lines(stored)))


def test_the_newest_dates_reach_the_scan(stored):
    assert "GreaterThanOrEqual(InvoiceDate,ScalarSubquery" in plan(kpi.daily_trends(stored))


READS = {
    kpi.daily_metrics_by_date: 2, kpi.daily_metrics: 2, kpi.daily_document: 3, kpi.daily_trends: 2, kpi.weekly_total: 2,
    kpi.business_metrics: 1, products.product_performance: 1, customers.customer_segments_fixed: 1,
}


@pytest.mark.parametrize("report", READS, ids=lambda r: r.__name__)
def test_reads_of_reports(stored, report):
    takes_raw = report in (kpi.daily_trends, products.product_performance, customers.customer_segments_fixed)
    text = plan(report(stored if takes_raw else kpi.order_lines(stored)))
    assert text.count("Location: InMemoryFileIndex") <= READS[report]


@pytest.mark.parametrize(
    "report, reads",
    [(quality.quality_report, 3), (reports.analytics_report, 1), (reports.analytics_summary, 1), (customers.customer_segments_quantile, 1), (quality.iqr_outliers, 1)],
    ids=lambda x: getattr(x, "__name__", str(x)),
)
def test_reads_of_reports_that_keep_a_table(spark, stored, report, reads):
    """Counted by the rows that the scans read while the report is made and collected."""
    df = kpi.order_lines(stored) if report is customers.customer_segments_quantile else stored
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    options = {"date_column": "InvoiceDate"} if report is quality.quality_report else {}
    report(df.mapInArrow(counted, df.schema), **options).collect()
    assert seen.value <= reads * df.count()


@pytest.mark.parametrize("report", [quality.column_profile, quality.cleaning_report, quality.invalid_values, kpi.daily_counts])
def test_one_scan(stored, report):
    df = kpi.order_lines(stored) if report is kpi.daily_counts else stored
    assert plan(report(df)).count("Location: InMemoryFileIndex") == 1


def test_rankings_drop_rows_before_the_shuffle(stored):
    assert "WindowGroupLimit" in plan(kpi.daily_breakdown(kpi.order_lines(stored)))
    assert "TakeOrderedAndProject" in plan(products.product_performance(stored))


def test_distinct_counts_spread_hot_groups(stored):
    """The first shuffle of a distinct count is on the group and the counted value."""
    text = plan(customers.customer_totals(kpi.order_lines(stored)))
    assert "hashpartitioning(CustomerID" in text and "InvoiceNo" in text.split("hashpartitioning(")[1].split(")")[0]


@pytest.mark.parametrize("report", [products.product_performance, kpi.business_metrics], ids=lambda r: r.__name__)
def test_distinct_counts_expand_no_line(stored, report):
    """Nothing is sorted or multiplied with its measures before the first shuffle."""
    text = plan(report(stored if report is products.product_performance else kpi.order_lines(stored)))
    assert "Expand" not in text and text.count("Location: InMemoryFileIndex") == 1


def test_days_add_up_to_periods(stored):
    daily = kpi.daily_customers(kpi.order_lines(stored))
    text = plan(kpi.customers_by_period(daily))
    assert "bitmap_or_agg" in text and text.count("Location: InMemoryFileIndex") == 1 and "Expand" not in text


LAZY_QUANTILES = {
    "trim_p99": lambda df: df.transform(cleaning.trim_p99),
    "iqr_outliers": quality.iqr_outliers,
    "describe_numeric": lambda df: quality.describe_numeric(df, ["Quantity", "UnitPrice"]),
    "order_batch_summary": lambda df: kpi.order_batch_summary(kpi.order_lines(df)),
    "cleaning_report": lambda df: quality.cleaning_report(df, aggressive=True),
    "with_quantile_segment": lambda df: customers.with_quantile_segment(customers.customer_totals(kpi.order_lines(df))),
}


@pytest.mark.parametrize("name", LAZY_QUANTILES)
def test_quantiles_start_no_job(spark, stored, name):
    group = f"quantiles-{name}"
    spark.sparkContext.setJobGroup(group, name)
    df = LAZY_QUANTILES[name](stored)
    plan(df)
    tracker = spark.sparkContext.statusTracker()
    assert not tracker.getJobIdsForGroup(group)
    df.collect()
    assert tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_quantiles_deal_values_out_by_ranges(spark):
    counts = spark.range(100).selectExpr("'a' as name", "id as v", "1L as n")
    text = plan(quantile_row(spark.range(1).selectExpr("id as a"), ["a"], [0.5], counts=counts))
    assert "rangepartitioning(" in text and text.count("rangepartitioning(") <= 2
