"""Order lines and event views over a folder of star-schema parquet tables.

Only the tables that the wanted columns come from are joined: look-ups by primary key never
add or drop a line, so leaving one out changes no other column.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schema import RAW_COLUMNS
from ordermill.sources.orders import JSON


# Known schemas, so that opening a table reads no file footers.
TABLES = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


# Column rules of the order-line view, first match wins.
RULES = {
    "InvoiceNo": "cast(l_orderkey as string)",
    "StockCode": "cast(l_partkey as string)",
    "Description": """case when l_partkey % 97 = 0 then null
        when l_partkey % 11 = 0 then concat('  ', p_name, ' ')
        when l_partkey % 13 = 0 and l_orderkey % 7 = 0 then concat(p_name, ' v2')
        else p_name end""",
    "Quantity": """cast(l_quantity as int) * case when l_orderkey % 53 = 0 then -1
        when l_orderkey % 59 = 0 then 0 when l_orderkey % 67 = 0 then 10 else 1 end""",
    "InvoiceDate": """timestampadd(minute, cast((l_orderkey * 37) % 1440 as int),
        cast(o_orderdate as timestamp))""",
    "UnitPrice": """cast((25 + (l_partkey * 7919) % 4000) * case when l_partkey % 89 = 0 then 0
        when l_partkey % 83 = 0 then 50 else 1 end as decimal(7,0)) * 0.01""",
    "CustomerID": "case when l_orderkey % 41 = 0 then null else o_custkey end",
    "Country": """case n_nationkey when 0 then 'UK' when 1 then 'UNITED KINGDOM'
        when 2 then ' USA ' when 3 then 'US' else n_name end""",
}


def retail_raw(spark: SparkSession, folder: str, columns: list[str] = RAW_COLUMNS, lines: DataFrame | None = None) -> DataFrame:
    """Raw order lines with the wanted ``columns``.

    ``lines`` replaces the line-item table, for instance by a stream of it.
    """
    out = lines
    if lines is None:
        out = table(spark, folder, "lineitem")
    if {"InvoiceDate", "CustomerID", "Country"} & set(columns):
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        out = out.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "Description" in columns:
        parts = table(spark, folder, "part").select("p_partkey", "p_name")
        out = out.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "Country" in columns:
        customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
        out = out.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        out = out.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select(*[F.expr(RULES[c]).alias(c) for c in columns])


def retail_text(spark: SparkSession, folder: str, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """Raw lines with ``InvoiceDateText``, which for some invoices is not a date."""
    needed = [c for c in RAW_COLUMNS if c in columns or c in ("InvoiceNo", "InvoiceDate")]
    raw = retail_raw(spark, folder, needed)
    bad = F.col("InvoiceNo").cast("bigint") % 173 == 0
    text = F.when(bad, "not a date").otherwise(F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    return raw.withColumn("InvoiceDateText", text).select(*columns, "InvoiceDateText")


def order_messages(raw: DataFrame, *more: str) -> DataFrame:
    """Raw lines as JSON payloads; those of some invoices are cut short. ``more`` columns go along."""
    corrupt = F.col("InvoiceNo").cast("bigint") % 101 == 0
    payload = F.to_json(F.struct(*RAW_COLUMNS), JSON)
    return raw.select(F.when(corrupt, F.substring(payload, 1, 10)).otherwise(payload).alias("value"), *more)


#: Messages a file, and files a micro-batch where a batch is kept while its sinks are written, so that what is kept is bounded.
MESSAGES_A_FILE, FILES_A_BATCH = 500_000, 16


def write_messages(messages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text files of a bounded number of messages, compressed, as they are several times the tables they are made of."""
    messages.write.mode(mode).option("compression", "lz4").option("maxRecordsPerFile", MESSAGES_A_FILE).text(path)


def order_lifecycle(events: DataFrame, order_id: str = "event_id") -> DataFrame:
    """Arrivals and completions ``order_id, kind, ts, seq`` from the events table.

    One order per event by default. With ``user_id`` the orders of a user share an id, so ids
    arrive again and complete without being open.
    """
    ts = F.col("ts").cast("timestamp")
    done = F.timestamp_add("MINUTE", (F.col("event_id") % 45 + 1).cast("int"), ts)
    arrive = F.struct(F.lit("arrive").alias("kind"), ts.alias("at"), (F.col("event_id") * 2).alias("seq"))
    complete = F.struct(F.lit("complete").alias("kind"), done.alias("at"), (F.col("event_id") * 2 + 1).alias("seq"))
    steps = F.when(F.col("event_id") % 20 == 0, F.array(arrive)).otherwise(F.array(arrive, complete))
    spread = events.select(F.col(order_id).cast("string").alias("order_id"), F.explode(steps).alias("s"))
    return spread.select("order_id", "s.kind", F.col("s.at").alias("ts"), "s.seq")


def metric_readings(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("metric"),
        "value",
    )


def scoring_requests(lines: DataFrame, *more: str) -> DataFrame:
    """Scoring requests made of order lines, some without hour or country."""
    return lines.select(
        *more,
        F.col("Quantity").alias("quantity"),
        F.col("UnitPrice").alias("unit_price"),
        F.when(F.col("CustomerID") % 5 != 0, F.col("Hour")).alias("hour"),
        F.col("DayOfWeek").alias("day_of_week"),
        F.col("Month").alias("month"),
        F.when(F.col("CustomerID") % 7 != 0, F.col("Country")).alias("country"),
    )
