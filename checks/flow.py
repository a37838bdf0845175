"""Order flow, metric tables and streams. Streams read the given tables, or messages written
from them, and are checked against the SQL of the same rules on the whole tables."""

from pyspark.sql import functions as F

from checks.base import RAW, half_up, query, raw, text, with_lines
from checks.model import PRICED, fitted
from checks.quality import DATE, PRICE
from checks.sources import foreign_message_files
from ordermill.operators import flow, metrics
from ordermill.session import fresh_path, shuffles_removed
from checks.warehouse import FILES_A_BATCH, TABLES, metric_readings, order_lifecycle, order_messages, table, write_messages
from ordermill.streaming import alerts
from ordermill.streaming import flow as stream_flow
from ordermill.streaming import orders as stream

AS_OF = "2024-01-15 12:00:00"
RECENT = f"completion > timestamp '{AS_OF}' - interval 60 minute"


def lifecycle(order_id: str) -> str:
    return f"""lifecycle as (
      select cast({order_id} as varchar) as order_id, 'arrive' as kind, ts, event_id * 2 as seq from events
      union all select cast({order_id} as varchar), 'complete',
        ts + interval '1' minute * (1 + event_id % 45), event_id * 2 + 1 from events where event_id % 20 <> 0),
    ordered as (select *, lag(kind) over w as kind_before, lag(ts) over w as arrival
      from lifecycle window w as (partition by order_id order by ts, seq)),
    matched as (select order_id, arrival, ts as completion, epoch_us(ts) - epoch_us(arrival) as lead
      from ordered where kind = 'complete' and kind_before = 'arrive')"""


MATCHED = f"""select order_id, {text('arrival')} as arrival_time, {text('completion')} as completion_time,
  lead / 60000000 as lead_time_minutes from matched"""


def events(spark, folder, order_id="event_id"):
    return order_lifecycle(table(spark, folder, "events"), order_id)


@query("matched_orders", f"with {lifecycle('event_id')} {MATCHED}")
def matched_orders(spark, folder):
    """One order per event."""
    return flow.match_lifecycle(events(spark, folder))


@query("matched_orders_by_user", f"with {lifecycle('user_id')} {MATCHED}")
def matched_orders_by_user(spark, folder):
    """J4 where orders arrive again while open, and complete while closed."""
    return flow.match_lifecycle(events(spark, folder, "user_id"))


def law(order_id: str) -> str:
    return f"""with {lifecycle(order_id).replace('from lifecycle window', f"from lifecycle where ts <= timestamp '{AS_OF}' window")},
    measured as (select
      (select count(*) from (select arg_max(kind, (ts, seq)) as last from lifecycle
        where ts <= timestamp '{AS_OF}' group by order_id) where last = 'arrive') as l,
      count(*) filter (arrival > timestamp '{AS_OF}' - interval 60 minute) / 60 as rate,
      coalesce(sum(lead) filter (completion > timestamp '{AS_OF}' - interval 60 minute) / 60000000
        / count(*) filter (completion > timestamp '{AS_OF}' - interval 60 minute), 0) as w,
      coalesce({half_up(f"sum(lead) filter ({RECENT})", f"60000000 * count(*) filter ({RECENT})")}, 0) as lead_time,
      count(*) as completed from matched)
    select l as l_work_in_progress, round(rate, 3) as lambda_arrival_rate, lead_time as w_lead_time_minutes,
      round(rate * w, 2) as littles_law_predicted, round(abs(l - rate * w), 2) as difference,
      abs(l - rate * w) < 1.0 as is_balanced, '{AS_OF}' as as_of, """


@query("littles_law", law("event_id") + "completed as total_completed from measured")
def littles_law(spark, folder):
    """ST6 at one instant."""
    return flow.littles_law(events(spark, folder), AS_OF)


@query("littles_law_by_user", law("user_id") + "completed as total_completed from measured")
def littles_law_by_user(spark, folder):
    """ST6 with arrivals that replace each other."""
    return flow.littles_law(events(spark, folder, "user_id"), AS_OF)


@query("flow_report", law("event_id") + """completed as total_orders_processed, l as orders_currently_processing,
  case when abs(l - rate * w) < 1.0 then 'balanced' else 'imbalanced' end as system_status from measured""")
def flow_report(spark, folder):
    """ST7."""
    return flow.flow_report(events(spark, folder), AS_OF)


WINDOWS = f"""select {text('start')} as window_start, {text("start + interval 60 minute")} as window_end,
  count(*) as completions, {half_up('sum(lead)', '60000000 * count(*)')} as w_lead_time_minutes,
  round(count(*) / 60, 3) as throughput_per_minute
from (select lead, time_bucket(interval 5 minute, completion) - interval 5 minute * k as start
  from matched, range(12) t(k)) group by start"""


@query("flow_windows", f"with {lifecycle('event_id')} {WINDOWS}")
def flow_windows(spark, folder):
    """ST6 per sliding window."""
    return flow.flow_windows(flow.match_lifecycle(events(spark, folder)))


@query("open_orders_by_hour", f"""with {lifecycle('user_id')},
changes as (select date_trunc('hour', ts) as hour, sum(case
  when kind = 'arrive' and coalesce(kind_before, '') <> 'arrive' then 1
  when kind = 'complete' and kind_before = 'arrive' then -1 else 0 end) as net_change from ordered group by 1)
select {text('hour')} as hour, cast(net_change as bigint) as net_change,
  cast(sum(net_change) over (order by hour) as bigint) as open_orders from changes""")
def open_orders_by_hour(spark, folder):
    """ST6: open orders over time."""
    return flow.open_by_hour(events(spark, folder, "user_id"))


LIMITS = {"click": (80.0, 95.0), "purchase": (400.0, 480.0)}


def status(limits: dict) -> str:
    def cut(which: int, default: int) -> str:
        return f"case event_type {' '.join(f'''when '{m}' then {w[which]}''' for m, w in limits.items())} else {default} end"

    return f"""case when value >= {cut(1, 95)} then 'critical' when value >= {cut(0, 80)} then 'warning'
      when value is null then 'unknown' else 'healthy' end"""


READINGS = f"""readings as (select event_id as reading_id, ts, event_type as metric, value, {status(LIMITS)} as status
  from events)"""


def readings(spark, folder):
    return metric_readings(table(spark, folder, "events"))


@query("status_level", f"with {READINGS} select reading_id, {text('ts')} as ts, metric, value, status from readings")
def status_level(spark, folder):
    """K1."""
    return metrics.status_level(readings(spark, folder), LIMITS)


SYSTEM = {"click": "CPU", "view": "memory"}
ALERTS = f"""select reading_id, 'system' as type, status as level,
  'High ' || case metric when 'click' then 'CPU' else 'memory' end || ' usage: '
    || cast(cast(value as decimal(18,2)) as varchar) || '%' as message, {text('ts')} as ts
from readings where status in ('warning', 'critical') and metric in ('click', 'view')"""


@query("metric_alerts", f"with {READINGS} {ALERTS}")
def metric_alerts(spark, folder):
    """K2: clicks stand for processor readings, purchases for response times, which raise no alerts."""
    return metrics.metric_alerts(readings(spark, folder), LIMITS, SYSTEM)


SERVICE = f"""select event_id as reading_id, 'api' as type, case event_type when 'signup' then 'critical' else 'warning' end as level,
  case when event_type = 'signup' then 'ML API is offline' when user_id % 2 = 0 then 'ML API error: Unknown error'
    else 'ML API error: user ' || user_id end as message, {text('ts')} as ts
from events where event_type in ('signup', 'error')"""


def service_states(spark, folder):
    """Events as states of a service: a signup stands for an offline one."""
    state = F.when(F.col("event_type") == "signup", "offline").otherwise(F.col("event_type"))
    return table(spark, folder, "events").select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        state.alias("state"),
        F.when(F.col("user_id") % 2 == 1, F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("error"),
    )


@query("service_alerts", SERVICE)
def service_alerts(spark, folder):
    """K2 for service states."""
    return metrics.service_alerts(service_states(spark, folder))


@query("alert_breakdown", f"""with {READINGS}, every as (select type from ({ALERTS}) union all select type from ({SERVICE}))
select coalesce(type, 'all') as type, count(*) as alerts from every group by rollup (type)""")
def alert_breakdown(spark, folder):
    """K3: alerts by type over system and service alerts."""
    system = metrics.metric_alerts(readings(spark, folder), LIMITS, SYSTEM)
    return metrics.alert_breakdown(system, metrics.service_alerts(service_states(spark, folder)))


@query("session_report", f"""with {READINGS}
select coalesce(metric, 'all') as metric, count(*) as checks, round(avg(value), 1) as avg_value,
  round(max(value), 1) as max_value, count(*) filter (status in ('warning', 'critical')) as alerts,
  count(*) filter (status = 'critical') as critical_alerts from readings group by rollup (metric)""")
def session_report(spark, folder):
    """K3."""
    return metrics.session_report(readings(spark, folder), LIMITS)


READING = f"select event_id as reading_id, {text('ts')} as ts, event_type as metric, value"


@query("latest_metrics", f"{READING} from events order by events.ts desc, event_id desc limit 100")
def latest_metrics(spark, folder):
    """W4."""
    return metrics.latest_metrics(readings(spark, folder))


@query("latest_per_metric", f"""{READING}, place from (select *,
  row_number() over (partition by event_type order by ts desc, event_id desc) as place from events) where place <= 100""")
def latest_per_metric(spark, folder):
    """W4 per metric."""
    return metrics.latest_per_metric(readings(spark, folder))


# Streams.

GOOD = "cast(InvoiceNo as bigint) % 101 <> 0"
STREAMED = f"streamed as (select * from retail_raw where {GOOD})"
SOLD = f"""{STREAMED}, sold as (select *, Quantity * cast(round(UnitPrice * 100) as bigint) as cents
  from streamed where Quantity > 0 and UnitPrice > 0)"""


def messages(spark, folder, **read):
    """The order lines as a stream of JSON payloads, some of them corrupt."""
    path = fresh_path(spark, "messages")
    write_messages(order_messages(raw(spark, folder)), path)
    return stream.read_order_stream(spark, path, **read)


FILES_A_YEAR = 8


def yearly_messages(spark, folder):
    """The same payloads, a year written after the other, each by eight tasks into as many files."""
    path = fresh_path(spark, "messages")
    dated = raw(spark, folder)
    years = dated.withColumn("year", F.coalesce(F.year("InvoiceDate"), F.lit(0)))
    order_messages(years, "year").write.option("compression", "zstd").partitionBy("year").parquet(f"{path}-dated")
    stored = spark.read.schema("value string, year int").parquet(f"{path}-dated")
    with shuffles_removed(spark):
        for year in [r["year"] for r in stored.select("year").distinct().orderBy("year").collect()]:
            dealt = stored.where(F.col("year") == year).select("value").repartition(FILES_A_YEAR)
            dealt.write.mode("append").option("compression", "lz4").text(path)
    return path


def appended(spark, streamed):
    """Run a stream of finished rows to its end and read what it wrote."""
    path = fresh_path(spark, "stream")
    stream.append_to(streamed, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(streamed.schema).parquet(f"{path}/rows")


@query("stream_orders", f"""with {RAW}, {STREAMED} select InvoiceNo, StockCode, Description, Quantity, {DATE}, {PRICE},
  CustomerID, Country from streamed""")
def stream_orders(spark, folder):
    """S7, S8, ST1."""
    return appended(spark, stream.parse_orders(messages(spark, folder)))


@query("stream_dead_letters", f"""with {RAW} select '{{"InvoiceN' as value, count(*) as n
from retail_raw where not ({GOOD})""")
def stream_dead_letters(spark, folder):
    """ST1: payloads that are no orders."""
    return appended(spark, stream.dead_letters(messages(spark, folder))).groupBy("value").count().withColumnRenamed("count", "n")


@query("stream_clean", f"""with {RAW}, {SOLD} select InvoiceNo, StockCode,
  coalesce(Description, 'Unknown Product') as Description, Quantity, {DATE}, {PRICE},
  coalesce(CustomerID, 99999) as CustomerID, coalesce(Country, 'Unknown') as Country from sold""")
def stream_clean(spark, folder):
    """ST8, P22."""
    return appended(spark, stream.stream_clean(stream.parse_orders(messages(spark, folder))))


@query("stream_alerts", f"""with {RAW}, {SOLD} select InvoiceNo, StockCode, Quantity, {PRICE},
  cast(cents as double) / 100 as Revenue from sold where cents > 10000""")
def stream_alerts(spark, folder):
    """ST2, ST4, P7."""
    orders = stream.stream_clean(stream.parse_orders(messages(spark, folder)))
    alerts = stream.high_value_alerts(stream.stream_revenue(orders))
    return appended(spark, alerts.select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "Revenue"))


def scored_stream(spark, folder, model, encoders=None):
    """Score the stream and raise alerts, each to a table of its own; reads back the scores."""
    path = fresh_path(spark, "scores")
    orders = stream.stream_clean(stream.parse_orders(messages(spark, folder, files_per_batch=FILES_A_BATCH)))
    sinks = {
        "scores": lambda batch: stream.stream_score(batch, model, encoders),
        "alerts": lambda batch: stream.high_value_alerts(stream.stream_revenue(batch)),
    }
    stream.write_batches(orders, sinks, path).awaitTermination()
    return spark.read.parquet(f"{path}/scores").drop("batch_id")


@query("stream_scores", f"""{with_lines('')}, {PRICED}, {SOLD},
priced as (select *, case when UnitPrice <= 2 then 'Low' when UnitPrice <= 5 then 'Medium'
  when UnitPrice <= 15 then 'High' else 'Premium' end as PriceCategory from sold)
select InvoiceNo, StockCode, Quantity, {PRICE}, cast(cents as double) / 100 as Revenue,
  cast((p4 * Quantity + 50) // 100 as double) / 100 as predicted_revenue from priced join prices using (PriceCategory)""")
def stream_scores(spark, folder):
    """ST3, ST4, M8 with the mean-price model."""
    return scored_stream(spark, folder, fitted(spark, folder)[1])


@query("stream_scores_forest")
def stream_scores_forest(spark, folder):
    """ST3 with the forest, saved and loaded."""
    from checks.model import trained

    forest, dictionary, _, _ = trained(spark, folder)
    return scored_stream(spark, folder, forest, dictionary)


@query("stream_revenue_only", f"""with {RAW}, {SOLD} select InvoiceNo, StockCode, Quantity, {PRICE},
  cast(cents as double) / 100 as Revenue, cast(null as double) as predicted_revenue from sold""")
def stream_revenue_only(spark, folder):
    """ST3 without a model, ST2."""
    return scored_stream(spark, folder, None)


HOURS = f"""select {text("date_trunc('hour', InvoiceDate)")} as window_start,
  {text("date_trunc('hour', InvoiceDate) + interval 1 hour")} as window_end,
  cast(sum(cents) as double) / 100 as revenue, count(*) as orders, count(*) filter (cents > 10000) as alerts
from sold group by 1, 2"""


@query("windowed_revenue", f"""with {RAW}, sold as (select *, Quantity * cast(round(UnitPrice * 100) as bigint) as cents
  from retail_raw where Quantity > 0 and UnitPrice > 0) {HOURS}""")
def windowed_revenue(spark, folder):
    """ST9 on the table."""
    orders = stream.stream_revenue(stream.stream_clean(raw(spark, folder)))
    return stream.windowed_revenue(orders)


@query("stream_windowed_revenue", f"with {RAW}, {SOLD} {HOURS}")
def stream_windowed_revenue(spark, folder):
    """ST9 on the stream: a micro-batch for each year, in order, with the library's watermark."""
    path = fresh_path(spark, "windows")
    payloads = stream.read_order_stream(spark, yearly_messages(spark, folder), files_per_batch=FILES_A_YEAR)
    orders = stream.stream_revenue(stream.stream_clean(stream.parse_orders(payloads)))
    sinks = {"windows": lambda batch: batch}
    stream.write_batches(stream.windowed_revenue(orders), sinks, path, "update").awaitTermination()
    return stream.latest_rows(spark.read.parquet(f"{path}/windows"), ["window_start"])


def streamed_flow(spark, folder, order_id="event_id"):
    """Run the lifecycle events as a stream; returns the folder of its tables."""
    path = fresh_path(spark, "flow")
    source = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(folder)
    stream_flow.order_flow(order_lifecycle(source, order_id), path).awaitTermination()
    return path


@query("stream_matched_orders", f"with {lifecycle('user_id')} {MATCHED}")
def stream_matched_orders(spark, folder):
    """ST5."""
    return spark.read.parquet(f"{streamed_flow(spark, folder, 'user_id')}/completed").drop("batch_id")


@query("stream_open_orders", f"""with {lifecycle('user_id')}
select order_id, {text('max(ts)')} as arrival_time, arg_max(seq, (ts, seq)) as seq from lifecycle
group by order_id having arg_max(kind, (ts, seq)) = 'arrive'""")
def stream_open_orders(spark, folder):
    """ST5: what stays open."""
    return stream_flow.last_open(spark, streamed_flow(spark, folder, "user_id"))


@query("stream_flow_windows", f"with {lifecycle('event_id')} {WINDOWS}")
def stream_flow_windows(spark, folder):
    """ST6: sliding windows over the stream of completed orders."""
    path = streamed_flow(spark, folder)
    schema = "order_id string, arrival_time timestamp, completion_time timestamp, lead_time_minutes double"
    completed = spark.readStream.schema(schema).parquet(f"{path}/completed/*")
    windows = stream_flow.windowed_flow(completed)
    stream.write_batches(windows, {"windows": lambda batch: batch}, f"{path}/windowed", "update").awaitTermination()
    return stream.latest_rows(spark.read.parquet(f"{path}/windowed/windows"), ["window_start"])


def sessions(more: str = "") -> str:
    return f"""gaps as (select *, case when InvoiceDate <= lag(InvoiceDate) over w + interval 30 minute then 0 else 1 end as opens
      from (select coalesce(CustomerID, 99999) as CustomerID, InvoiceDate, cents from sold where InvoiceDate is not null)
      window w as (partition by CustomerID order by InvoiceDate)),
    islands as (select *, sum(opens) over (partition by CustomerID order by InvoiceDate) as island from gaps)
    select CustomerID, {text('min(InvoiceDate)')} as session_start, {text("max(InvoiceDate) + interval 30 minute")} as session_end,
      cast(sum(cents) as double) / 100 as revenue, count(*) as orders from islands group by CustomerID, island {more}"""


@query("session_revenue", f"""with {RAW}, sold as (select *, Quantity * cast(round(UnitPrice * 100) as bigint) as cents
  from retail_raw where Quantity > 0 and UnitPrice > 0), {sessions()}""")
def session_revenue(spark, folder):
    """ST9: sessions of the table."""
    return stream.session_revenue(stream.stream_revenue(stream.stream_clean(raw(spark, folder))))


@query("stream_session_revenue", f"""with {RAW}, {SOLD},
{sessions("having max(InvoiceDate) + interval 30 minute <= (select max(InvoiceDate) from sold) - interval 10 minute")}""")
def stream_session_revenue(spark, folder):
    """ST9: sessions of the stream that the watermark has passed, each written once."""
    payloads = stream.read_order_stream(spark, yearly_messages(spark, folder), files_per_batch=FILES_A_YEAR)
    orders = stream.stream_revenue(stream.stream_clean(stream.parse_orders(payloads)))
    return appended(spark, stream.session_revenue(orders))


def lifecycle_stream(spark, folder, order_id="event_id"):
    source = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(folder)
    return order_lifecycle(source, order_id)


@query("stream_joined_orders", f"""with {lifecycle('event_id')},
passed as (select least(max(ts) filter (kind = 'arrive'), max(ts) filter (kind = 'complete')) - interval 10 minute as at from lifecycle)
{MATCHED} union all
select order_id, {text('ts')}, null, null from lifecycle a, passed where kind = 'arrive' and a.ts + interval 1 hour < passed.at
  and not exists (select 1 from matched m where m.order_id = a.order_id)""")
def stream_joined_orders(spark, folder):
    """ST5: arrivals with their completions, or without one after an hour, by a join of two streams."""
    return appended(spark, stream_flow.joined_flow(lifecycle_stream(spark, folder)))


def law_sql(order_id: str, passed: str) -> str:
    return f"""with {lifecycle(order_id)},
    hours as (select date_trunc('hour', ts) as hour,
      count(*) filter (kind = 'arrive' and coalesce(kind_before, '') <> 'arrive') as arrivals,
      count(*) filter (kind = 'complete' and kind_before = 'arrive') as completions,
      sum(epoch_us(ts) - epoch_us(arrival)) filter (kind = 'complete' and kind_before = 'arrive') as lead
      from ordered group by 1)
    select {text('hour')} as window_start, {text('hour + interval 1 hour')} as window_end,
      cast(sum(arrivals - completions) over (order by hour) as bigint) as l_work_in_progress, round(arrivals / 60, 3) as lambda_arrival_rate,
      {half_up('lead', '60000000 * completions')} as w_lead_time_minutes, arrivals, completions
    from hours where {passed}"""


@query("law_windows", law_sql("user_id", "true"))
def law_windows(spark, folder):
    """ST6: L, lambda and W of every hour, with arrivals that replace each other."""
    return flow.law_windows(events(spark, folder, "user_id"))


@query("stream_littles_law", law_sql("user_id", "hour + interval 1 hour <= (select max(ts) from lifecycle) - interval 10 minute"))
def stream_littles_law(spark, folder):
    """ST6: the same on the stream, for hours that the watermark has passed."""
    path = fresh_path(spark, "law")
    stream_flow.law_on_stream(lifecycle_stream(spark, folder, "user_id"), path).awaitTermination()
    return spark.read.parquet(f"{path}/windows").drop("batch_id")


@query("stream_alert_changes", f"""with {READINGS}, steps as (select *,
  coalesce(lag(status) over (partition by metric order by ts, reading_id), 'healthy') as level_before from readings)
select metric, {text('ts')} as ts, reading_id, level_before, status as level from steps where status <> level_before""")
def stream_alert_changes(spark, folder):
    """K2 on a stream in which every reading comes twice: an alert wherever the level of a metric changes."""
    path = fresh_path(spark, "readings")
    read = readings(spark, folder)
    for _ in range(2):
        read.write.mode("append").parquet(path)
    streamed = spark.readStream.schema(read.schema).parquet(path)
    with stream_flow.on_rocksdb(spark):
        return appended(spark, alerts.level_changes(streamed, LIMITS))


REASONS = f"""with {RAW}, kinds as (select *, cast(InvoiceNo as bigint) as i from retail_raw), fields as (select *, array_to_string(list_filter([
    case when i % 29 = 0 then 'Quantity' end, case when i % 37 = 0 then 'InvoiceDate' end, case when i % 31 = 0 then 'CustomerID' end],
    lambda x: x is not null), ',') as untyped from kinds)
select case when i % 23 = 0 or i % 19 = 0 then 'missing' else 'untyped' end as reason,
  case when i % 23 = 0 then 'InvoiceNo,Quantity,UnitPrice' when i % 19 = 0 then 'UnitPrice' else untyped end as fields, count(*) as n
from fields where i % 23 = 0 or i % 19 = 0 or untyped <> '' group by 1, 2"""


@query("stream_dead_letter_reasons", REASONS)
def stream_dead_letter_reasons(spark, folder):
    """ST1: the dead letters of the stream, a sink of their own, by reason and fields."""
    path = fresh_path(spark, "sinks")
    payloads = stream.read_order_stream(spark, foreign_message_files(spark, folder), files_per_batch=FILES_A_BATCH)
    stream.order_sinks(payloads, path).awaitTermination()
    letters = spark.read.parquet(f"{path}/dead_letters")
    return letters.groupBy("reason", F.array_join("rejected_fields", ",").alias("fields")).agg(F.count(F.lit(1)).alias("n"))
