"""Business metrics: daily, weekly, customers, products."""

from pyspark.sql import functions as F

from checks.base import REVENUE, half_up, lines, mean_cents, query, raw, with_lines, with_raw
from ordermill.operators import cleaning, customers, kpi, products
from ordermill.plans import reports
from ordermill.session import fresh_path

TRENDS = f"""select cast(Date as varchar) as order_date, count(*) as total_orders,
  {REVENUE} as total_revenue, count(distinct CustomerID) as unique_customers,
  count(distinct StockCode) as unique_products, {mean_cents()} as avg_order_value
from lines group by Date"""

DAY_COUNTS = f"""select Date, count(*) as total_orders, {REVENUE} as total_revenue,
  count(distinct CustomerID) as unique_customers, count(distinct StockCode) as unique_products,
  {mean_cents()} as avg_order_value, cast(sum(Quantity) as bigint) as total_quantity,
  count(distinct Country) as countries_served
from lines group by Date"""

PEAKS = """select Date, Hour as peak_hour, cents / 100 as peak_hour_revenue from (
  select Date, Hour, cast(sum(cents) as double) as cents,
    row_number() over (partition by Date order by sum(cents) desc, Hour) as place
  from lines group by Date, Hour) where place = 1"""

LAST_DAY = "Date = (select max(Date) from lines)"


@query("daily_trends", with_lines(f"{TRENDS} order by Date desc limit 7"))
def daily_trends(spark, folder):
    """Trends of the newest seven dates."""
    return kpi.daily_trends(raw(spark, folder, "StockCode"))


@query("daily_trends_all", with_lines(TRENDS))
def daily_trends_all(spark, folder):
    """A5 for every date."""
    return kpi.daily_trends(raw(spark, folder, "StockCode"), days=None)


DAILY = f"""select * replace (cast(Date as varchar) as Date)
from ({DAY_COUNTS}) join ({PEAKS}) using (Date)"""


@query("daily_metrics", with_lines(f"{DAILY} where {LAST_DAY}"))
def daily_metrics(spark, folder):
    """A1, A2: metrics of the latest date."""
    return kpi.daily_metrics(lines(spark, folder, "StockCode", "Country"))


@query("daily_metrics_by_date", with_lines(DAILY))
def daily_metrics_by_date(spark, folder):
    """A1, A2 for every date."""
    return kpi.daily_metrics_by_date(lines(spark, folder, "StockCode", "Country"))


@query("peak_hour_by_date", with_lines(f"select * replace (cast(Date as varchar) as Date) from ({PEAKS})"))
def peak_hour_by_date(spark, folder):
    """A2: best hour of every date."""
    return kpi.peak_hour(lines(spark, folder, "InvoiceDate"))


def top(column: str, dimension: str, where: str = "true") -> str:
    return f"""select cast(Date as varchar) as Date, '{dimension}' as dimension, key, revenue, place from (
      select Date, cast({column} as varchar) as key, {REVENUE} as revenue,
        row_number() over (partition by Date
          order by sum(cents) desc, length(cast({column} as varchar)), cast({column} as varchar)) as place
      from lines where {column} is not null and {where} group by Date, {column}) where place <= 3"""


@query("top_customers_day", with_lines(top("CustomerID", "customer", LAST_DAY)))
def top_customers_day(spark, folder):
    """A3, O2."""
    return kpi.daily_top(lines(spark, folder, "CustomerID"), "customer")


@query("top_products_day", with_lines(top("StockCode", "product", LAST_DAY)))
def top_products_day(spark, folder):
    """A3, O2."""
    return kpi.daily_top(lines(spark, folder, "StockCode"), "product")


@query("top_countries_day", with_lines(top("Country", "country", LAST_DAY)))
def top_countries_day(spark, folder):
    """A3, O2."""
    return kpi.daily_top(lines(spark, folder, "Country"), "country")


@query("topk_per_date", with_lines(top("CustomerID", "customer")))
def topk_per_date(spark, folder):
    """Best three customers of every date."""
    return kpi.top_per_date(lines(spark, folder, "CustomerID"))


@query("daily_breakdown", with_lines(" union all ".join(
    top(c, d) for d, c in kpi.DAY_DIMENSIONS.items())))
def daily_breakdown(spark, folder):
    """A2, A3 for every date and dimension in one pass."""
    return kpi.daily_breakdown(lines(spark, folder, "StockCode", "Country"))


@query("daily_document", with_lines(f"""
select d.Date, total_orders, total_revenue, peak_hour, peak_hour_revenue, dimension, place, key, revenue
from ({DAILY}) d join ({top("CustomerID", "customer")} union all {top("StockCode", "product")}
  union all {top("Country", "country")}) t on d.Date = t.Date
where d.Date = (select cast(max(Date) as varchar) from lines)"""))
def daily_document(spark, folder):
    """A4, the nested row flattened to one row per entry of its arrays."""
    doc = kpi.daily_document(lines(spark, folder, "StockCode", "Country"))

    def entries(column, key, name):
        return F.transform(
            column,
            lambda e, i: F.struct(
                F.lit(name).alias("dimension"),
                (i + 1).alias("place"),
                e[key].cast("string").alias("key"),
                e["revenue"].alias("revenue"),
            ),
        )

    flat = F.concat(
        entries("top_customers", "customer_id", "customer"),
        entries("top_products", "product_code", "product"),
        entries("top_countries", "country", "country"),
    )
    return doc.select(
        "Date", "total_orders", "total_revenue", "peak_hour", "peak_hour_revenue", F.inline(flat)
    )


WEEK = f"""select Date, {REVENUE} as revenue, count(InvoiceNo) as orders,
  count(distinct CustomerID) as customers, sum(cents) as cents
from lines where Date >= (select max(Date) from lines) - 6 group by Date"""


@query("weekly_trends", with_lines(f"select cast(Date as varchar) as Date, revenue, orders, customers from ({WEEK})"))
def weekly_trends(spark, folder):
    """A6, W3."""
    return kpi.weekly_trends(lines(spark, folder, "InvoiceNo"))


def growth(value: str, time: str = "Date") -> str:
    change = half_up(f"100 * (arg_max({value}, {time}) - arg_min({value}, {time}))", f"arg_min({value}, {time})")
    return f"case when count(*) < 2 then 0.0 else {change} end"


@query("weekly_total", with_lines(f"""
select cast(max(Date) - 6 as varchar) as week_start, cast(max(Date) as varchar) as week_end,
  {REVENUE} as total_weekly_revenue, {growth("cents")} as revenue_growth, {growth("orders")} as orders_growth
from ({WEEK})"""))
def weekly_total(spark, folder):
    """A7, A8, W2."""
    return kpi.weekly_total(lines(spark, folder, "InvoiceNo"))


@query("growth_by_country", with_lines(f"""
select Country, count(*) as periods, {growth("cents", "month")} as revenue_growth
from (select Country, date_trunc('month', Date) as month, sum(cents) as cents from lines group by 1, 2) group by Country"""))
def growth_by_country(spark, folder):
    """W2 per group: growth from the first to the last month, of whatever year."""
    return kpi.growth_by(lines(spark, folder, "Country"), "Country")


@query("rolling_revenue", with_lines("""
select cast(Date as varchar) as Date, cast(cents as double) / 100 as revenue,
  cast(sum(cents) over (order by Date range between interval '6' day preceding and current row) as double) / 100
    as trailing_revenue
from (select Date, sum(cents) as cents from lines group by Date)"""))
def rolling_revenue(spark, folder):
    """W3 for every date."""
    return kpi.rolling_revenue(lines(spark, folder, "InvoiceDate"))


def fixed_segments(vip: int, high: int, medium: int) -> str:
    return f"""select case when cents >= {vip * 100} then 'VIP' when cents >= {high * 100} then 'High Value'
      when cents >= {medium * 100} then 'Medium Value' else 'Low Value' end as customer_segment,
      count(*) as customer_count, {mean_cents()} as avg_revenue,
      {half_up("sum(orders)", "count(*)")} as avg_order_frequency
    from (select CustomerID, sum(cents) as cents, count(distinct InvoiceNo) as orders
      from lines group by CustomerID) group by 1"""


@query("customer_segments_fixed", with_lines(fixed_segments(2000, 1000, 200)))
def customer_segments_fixed(spark, folder):
    """A9."""
    return customers.customer_segments_fixed(raw(spark, folder, "InvoiceNo"))


@query("customer_segments_floors", with_lines(fixed_segments(60000, 30000, 15000)))
def customer_segments_floors(spark, folder):
    """A9 with floors that this data spreads over."""
    floors = {"VIP": 60000, "High Value": 30000, "Medium Value": 15000}
    return customers.customer_segments_fixed(raw(spark, folder, "InvoiceNo"), floors)


@query("customer_lifetime", with_lines(f"""
select CustomerID, {REVENUE} as total_revenue, count(distinct InvoiceNo) as order_frequency,
  cast(sum(Quantity) as bigint) as total_quantity,
  strftime(min(InvoiceDate), '%Y-%m-%d %H:%M:%S') as first_order,
  strftime(max(InvoiceDate), '%Y-%m-%d %H:%M:%S') as last_order,
  date_sub('day', min(InvoiceDate), max(InvoiceDate)) as days_active
from lines group by CustomerID"""))
def customer_lifetime(spark, folder):
    """A10."""
    return customers.customer_lifetime(lines(spark, folder, "InvoiceNo"))


TOTALS = """totals as (select CustomerID, sum(cents) as cents, cast(sum(cents) as double) / 100 as revenue,
  count(distinct InvoiceNo) as orders from lines group by CustomerID),
cuts as (select quantile_cont(revenue, 0.33) as low, quantile_cont(revenue, 0.67) as mid,
  quantile_cont(revenue, 0.95) as high from totals),
labelled as (select *, case when revenue >= high then 'VIP' when revenue >= mid then 'High Value'
  when revenue >= low then 'Medium Value' else 'Low Value' end as segment from totals, cuts)"""


@query("customer_segments_quantile", f"""{with_lines("")}, {TOTALS}
select segment, count(*) as customer_count, {REVENUE} as total_revenue,
  {mean_cents()} as avg_revenue_per_customer, {half_up("sum(orders)", "count(*)")} as avg_order_frequency
from labelled group by segment""")
def customer_segments_quantile(spark, folder):
    """A11, J3."""
    return customers.customer_segments_quantile(lines(spark, folder, "InvoiceNo"))


@query("customer_segment_labels", f"""{with_lines("")}, {TOTALS}
select CustomerID, revenue as total_revenue, segment from labelled""")
def customer_segment_labels(spark, folder):
    """The segment of every customer."""
    totals = customers.customer_totals(lines(spark, folder, "InvoiceNo"))
    return customers.with_quantile_segment(totals).select("CustomerID", "total_revenue", "segment")


PRODUCTS = f"""select StockCode, coalesce(substr(min(Description), 1, 50), 'Unknown') as product_name,
  cast(sum(Quantity) as bigint) as total_quantity_sold, {REVENUE} as total_revenue,
  count(distinct CustomerID) as unique_customers, count(distinct InvoiceNo) as total_orders
from lines group by StockCode"""


@query("product_performance", with_lines(f"{PRODUCTS} order by sum(cents) desc, StockCode limit 10"))
def product_performance(spark, folder):
    """A12, P17."""
    return products.product_performance(raw(spark, folder, "InvoiceNo", "StockCode", "Description"))


@query("product_performance_all", with_lines(PRODUCTS))
def product_performance_all(spark, folder):
    """A12 for every product."""
    return products.product_performance(raw(spark, folder, "InvoiceNo", "StockCode", "Description"), None)


REPORT_TRENDS = f"{TRENDS} order by Date desc limit 7"
REPORT_PRODUCTS = f"{PRODUCTS} order by sum(cents) desc, StockCode limit 10"


@query("analytics_report", f"""{with_lines("")}, d as ({REPORT_TRENDS}), s as ({fixed_segments(2000, 1000, 200)}),
p as ({REPORT_PRODUCTS})
select 'daily_trends' as section, order_date as key, total_revenue as revenue, cast(total_orders as double) as orders,
  cast(unique_customers as double) as customers, cast(unique_products as double) as products,
  avg_order_value as avg_value, cast(null as double) as avg_frequency, cast(null as double) as quantity from d
union all select 'customer_segments', customer_segment, null, null, customer_count, null, avg_revenue,
  avg_order_frequency, null from s
union all select 'top_products', StockCode, total_revenue, total_orders, unique_customers, null, null, null,
  total_quantity_sold from p""")
def analytics_report(spark, folder):
    """Trends, segments and products as one result."""
    return reports.analytics_report(raw(spark, folder, "InvoiceNo", "StockCode", "Description"))


@query("analytics_summary", f"""{with_lines("")}, d as (select Date, sum(cents) as cents, count(*) as n
  from lines group by Date order by Date desc limit 7)
select count(*) as total_days_analyzed, {REVENUE} as total_revenue, cast(sum(n) as bigint) as total_orders,
  {mean_cents()} as average_daily_revenue,
  (select count(*) from ({fixed_segments(2000, 1000, 200)})) as customer_segments_identified,
  (select count(*) from ({REPORT_PRODUCTS})) as top_products_analyzed
from d""")
def analytics_summary(spark, folder):
    """A13."""
    return reports.analytics_summary(raw(spark, folder, "InvoiceNo", "StockCode", "Description"))


def complete_lines(spark, folder):
    whole = raw(spark, folder).transform(cleaning.drop_any_null)
    return whole.transform(cleaning.with_revenue).transform(cleaning.with_time_parts)


COMPLETE = """complete as (select * from lines where Description is not null and Country is not null)"""


@query("business_metrics", f"""{with_lines("")}, {COMPLETE}
select count(*) as total_transactions, {REVENUE} as total_revenue, {mean_cents()} as avg_order_value,
  count(distinct CustomerID) as unique_customers, count(distinct StockCode) as unique_products,
  count(distinct Country) as countries_served,
  date_sub('day', min(InvoiceDate), max(InvoiceDate)) as date_range_days,
  {half_up("count(*)", "count(distinct Date)")} as avg_daily_transactions,
  least(10000, count(*) // 100) as recommended_batch_size
from complete""")
def business_metrics(spark, folder):
    """A14, P2."""
    return kpi.business_metrics(complete_lines(spark, folder))


@query("top_countries", with_lines(f"""
select Country, {REVENUE} as revenue from lines where Country is not null
group by Country order by sum(cents) desc, Country limit 5"""))
def top_countries(spark, folder):
    """A15, O2."""
    return kpi.top_countries(lines(spark, folder, "Country"))


@query("top_products_by_quantity", with_lines("""
select StockCode, cast(sum(Quantity) as bigint) as units,
  coalesce(substr(min(Description), 1, 30), 'Unknown') as Description
from lines group by StockCode order by sum(Quantity) desc, StockCode limit 5"""))
def top_products_by_quantity(spark, folder):
    """A16, J1, P17."""
    return products.top_products_by_quantity(lines(spark, folder, "StockCode", "Description"))


@query("hourly_revenue", with_lines(f"select Hour, {REVENUE} as revenue from lines group by Hour"))
def hourly_revenue(spark, folder):
    """A17."""
    return kpi.hourly_revenue(lines(spark, folder, "InvoiceDate"))


@query("peak_hour_overall", with_lines(
    f"select Hour, {REVENUE} as revenue from lines group by Hour order by sum(cents) desc, Hour limit 1"))
def peak_hour_overall(spark, folder):
    """A17, A2."""
    return kpi.peak_hour_overall(lines(spark, folder, "InvoiceDate"))


WEEKDAYS = f"""select DayOfWeek, {REVENUE} as revenue, dayname(min(Date)) as day_name
from lines group by DayOfWeek"""


@query("weekday_revenue", with_lines(WEEKDAYS))
def weekday_revenue(spark, folder):
    """A18, P18."""
    return kpi.weekday_revenue(lines(spark, folder, "InvoiceDate"))


@query("peak_weekday", with_lines(f"{WEEKDAYS} order by sum(cents) desc, DayOfWeek limit 1"))
def peak_weekday(spark, folder):
    """A18, P18."""
    return kpi.peak_weekday(lines(spark, folder, "InvoiceDate"))


@query("order_batch_summary", with_lines(f"""
select count(*) as total_orders, {REVENUE} as total_revenue, {mean_cents()} as avg_order_value,
  count(distinct StockCode) as unique_products, count(distinct CustomerID) as unique_customers,
  count(distinct Country) as unique_countries, cast(min(cents) as double) / 100 as min_revenue,
  cast(max(cents) as double) / 100 as max_revenue, min(Quantity) as min_quantity, max(Quantity) as max_quantity,
  {half_up("sum(Quantity)", "count(*)")} as avg_quantity,
  quantile_cont(cast(cents as double) / 100, 0.5) as median_revenue
from lines"""))
def order_batch_summary(spark, folder):
    """A19."""
    return kpi.order_batch_summary(lines(spark, folder, "StockCode", "Country"))


def patterns(first: str) -> str:
    return with_raw(f"""select StockCode, cast(min(UnitPrice) as double) as min_price,
      cast(max(UnitPrice) as double) as max_price,
      {half_up("sum(cast(round(UnitPrice * 100) as bigint))", "100 * count(*)", 4)} as avg_price,
      min(Description) as description
    from retail_raw where UnitPrice > 0 and StockCode is not null {first} group by StockCode""")


@query("price_patterns", patterns(
    "and StockCode in (select distinct StockCode from retail_raw order by StockCode limit 200)"))
def price_patterns(spark, folder):
    """The first 200 products, the size of the profile."""
    return products.price_patterns(raw(spark, folder, "StockCode", "Description"))


@query("price_patterns_all", patterns(""))
def price_patterns_all(spark, folder):
    """A20 for every product."""
    return products.price_patterns(raw(spark, folder, "StockCode", "Description"), None)


@query("distinct_values", with_raw("""
select distinct 'product' as kind, StockCode as value from retail_raw where StockCode is not null
union all select distinct 'country', Country from retail_raw where Country is not null"""))
def distinct_values(spark, folder):
    """All products and countries."""
    return products.distinct_values(raw(spark, folder, "StockCode", "Country"))


RAW_CENTS = "select *, Quantity * cast(round(UnitPrice * 100) as bigint) as cents from retail_raw"


@query("simple_metrics", with_raw(f"""
select count(*) as total_orders, {REVENUE} as total_revenue, {mean_cents()} as avg_order_value,
  count(distinct CustomerID) as unique_customers, count(distinct StockCode) as unique_products
from ({RAW_CENTS})"""))
def simple_metrics(spark, folder):
    """Totals over all lines, uncleaned."""
    return kpi.simple_metrics(raw(spark, folder, "StockCode"))


@query("revenue_range", with_lines(f"""
select cast(min(cents) as double) / 100 as min_revenue, cast(max(cents) as double) / 100 as max_revenue,
  {mean_cents()} as mean_revenue from lines"""))
def revenue_range(spark, folder):
    """A23."""
    return kpi.revenue_range(raw(spark, folder).transform(cleaning.clean_for_schedule))


@query("order_mix", with_lines("""
select order_type, count(*) as orders, cast(sum(cents) as double) / 100 as revenue from (
  select *, case when place <= 0.6 then 'random' when place <= 0.6 + 0.2 then 'high_value'
    when place <= 0.6 + 0.2 + 0.1 then 'bulk' else 'single' end as order_type
  from (select *, cast(('0x' || substr(md5(InvoiceNo), 1, 8))::bigint as double) / 4294967296 as place from lines))
group by order_type"""))
def order_mix(spark, folder):
    """Invoices dealt into the order mix, with their revenue."""
    dealt = kpi.assign_mix(lines(spark, folder, "InvoiceNo"), F.md5("InvoiceNo"))
    return dealt.groupBy("order_type").agg(kpi.rows().alias("orders"), kpi.total_revenue().alias("revenue"))


@query("customers_by_period", with_lines("""
select period, cast(cast(date_trunc(period, Date) as date) as varchar) as start, count(distinct CustomerID) as unique_customers
from lines, (values ('week'), ('month'), ('year')) as p(period) group by period, date_trunc(period, Date)"""))
def customers_by_period(spark, folder):
    """Distinct customers of every week, month and year from the stored bitmaps of the days."""
    path = fresh_path(spark, "daily-customers")
    kpi.daily_customers(lines(spark, folder, "InvoiceDate")).write.parquet(path)
    return kpi.customers_by_period(spark.read.parquet(path))
