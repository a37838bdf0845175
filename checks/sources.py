"""Readers, writers and samples. Files are written from the given tables and read back."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import warehouse
from checks.base import RAW, ROW_KEY, lines, query, raw, with_lines, with_raw
from checks.quality import CLEAN, DATE, PARTS, PRICE
from ordermill.operators import cleaning, features, kpi
from ordermill.schema import RAW_COLUMNS
from ordermill.session import fresh_path
from ordermill.sources import orders as O
from ordermill.streaming import orders as stream
from checks import warehouse

ROW = f"InvoiceNo, StockCode, Description, Quantity, {DATE}, {PRICE}, CustomerID, Country"


@query("orders_csv", with_raw(f"select {ROW} from retail_raw"))
def orders_csv(spark, folder):
    """Order lines through Latin-1 CSV files."""
    path = O.write_csv(raw(spark, folder), fresh_path(spark, "csv"), "run")
    return O.read_orders_csv(spark, path)


@query("clean_orders_csv", with_lines(f"select {CLEAN} from lines"))
def clean_orders_csv(spark, folder):
    """Cleaned lines through CSV files."""
    cleaned = raw(spark, folder).transform(cleaning.clean_for_ml)
    path = O.write_csv(cleaned.drop("Date"), fresh_path(spark, "clean-csv"), "run")
    return O.read_clean_csv(spark, path, cleaned.drop("Date").schema)


@query("orders_json", with_raw(f"select {ROW} from retail_raw"))
def orders_json(spark, folder):
    """Order lines published as JSON payloads and read back."""
    path = fresh_path(spark, "json")
    O.publish_orders(raw(spark, folder), path)
    return O.read_orders_json(spark, path, multi_line=False)


# Files of other hands: their text is put together by SQL rules, not by this library's writers.

FOREIGN_PRICE = """case StockCode % 5 when 0 then '0.001' when 1 then '0.055' else {price} end"""
BAD_DATE, BAD_CUSTOMER, BAD_QUANTITY = "InvoiceNo % 37 = 0", "InvoiceNo % 31 = 0", "InvoiceNo % 29 = 0"


def foreign(spark, folder):
    """Raw lines with every field as the text that spreadsheets and float columns make of it."""
    return raw(spark, folder).selectExpr(
        "InvoiceNo",
        "StockCode",
        "Description",
        f"case when {BAD_QUANTITY} then 'many' else cast(Quantity as string) end as Quantity",
        f"""case when {BAD_DATE} then 'soon' when InvoiceNo % 3 = 0 then date_format(InvoiceDate, 'M/d/yyyy H:mm')
          when InvoiceNo % 3 = 1 then date_format(InvoiceDate, 'yyyy-MM-dd HH:mm')
          else concat(date_format(InvoiceDate, "yyyy-MM-dd'T'HH:mm:ss"), '.123456') end as InvoiceDate""",
        FOREIGN_PRICE.format(price="cast(cast(UnitPrice as decimal(12,2)) as string)") + " as UnitPrice",
        f"case when {BAD_CUSTOMER} then 'x' else concat(CustomerID, '.0') end as CustomerID",
        "Country",
    )


BAD = " or ".join(f"cast(InvoiceNo as bigint) {c.removeprefix('InvoiceNo ')}" for c in (BAD_DATE, BAD_CUSTOMER, BAD_QUANTITY))


def unless(condition: str, value: str) -> str:
    return f"case when cast(InvoiceNo as bigint) {condition.removeprefix('InvoiceNo ')} then null else {value} end"


FOREIGN = f"""with {RAW}, typed as (select InvoiceNo, StockCode, Description, {unless(BAD_QUANTITY, 'Quantity')} as Quantity,
  {unless(BAD_DATE, 'InvoiceDate')} as InvoiceDate, case cast(StockCode as bigint) % 5 when 0 then 0.001 when 1 then 0.055
    else UnitPrice end as UnitPrice, {unless(BAD_CUSTOMER, 'CustomerID')} as CustomerID, Country from retail_raw)"""
FOREIGN_ROW = f"""{FOREIGN} select InvoiceNo, StockCode, Description, Quantity, {DATE},
  cast(UnitPrice as double) as UnitPrice, CustomerID, Country from typed"""
# A line whose customer is missing and not just untyped is no reject.
REJECTS = f"""with {RAW} select InvoiceNo, StockCode, array_to_string(list_filter([
  case when cast(InvoiceNo as bigint) % 29 = 0 then 'Quantity' end, case when cast(InvoiceNo as bigint) % 37 = 0 then 'InvoiceDate' end,
  case when cast(InvoiceNo as bigint) % 31 = 0 then 'CustomerID' end], lambda x: x is not null), ',') as fields
from retail_raw where {BAD}"""


def foreign_csv(spark, folder):
    """Files as Spark's own writer makes them of the texts, each with its header."""
    path = fresh_path(spark, "foreign-csv")
    foreign(spark, folder).write.options(**O.CSV).csv(path)
    return path


@query("foreign_csv", FOREIGN_ROW)
def read_foreign_csv(spark, folder):
    """Spreadsheet dates, customers with a point, prices under a cent, fields of the wrong type."""
    return O.read_orders_csv(spark, foreign_csv(spark, folder))


@query("foreign_csv_rejects", REJECTS)
def foreign_csv_rejects(spark, folder):
    """Lines with fields that aren't of their type, and which."""
    rejected = O.rejected_orders(O.read_csv_text(spark, foreign_csv(spark, folder)))
    return rejected.select("InvoiceNo", "StockCode", F.array_join("rejected_fields", ",").alias("fields"))


def json_of(columns: list) -> str:
    """One JSON object by concatenation, nulls left out."""
    cells = ", ".join(f"concat('\"{c}\": \"', {c}, '\"')" for c in columns)
    return f"concat('{{', concat_ws(', ', {cells}), '}}')"


@query("foreign_json", FOREIGN_ROW)
def read_foreign_json(spark, folder):
    """Files that each hold a JSON array of up to 65,536 orders, with microseconds and floats."""
    path = fresh_path(spark, "foreign-json")
    some = F.shiftright(F.monotonically_increasing_id(), 16)
    orders = foreign(spark, folder).select(F.expr(json_of(RAW_COLUMNS)).alias("value"), some.alias("file"))
    arrays = orders.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value"))
    arrays.write.partitionBy("file").text(path)
    return O.read_orders_json(spark, f"{path}/*")


# Files with broken records: lines that end too early or go on, and JSON that is cut.

SHORT, LONG, CUT = "InvoiceNo % 43 = 0", "InvoiceNo % 47 = 0", 20
WIDTHS = "not (cast(InvoiceNo as bigint) % 43 = 0 or cast(InvoiceNo as bigint) % 47 = 0)"


def broken_csv(spark, folder):
    """Lines without a header, put together by SQL: every field in quotes but numbers and times."""
    path = fresh_path(spark, "broken-csv")
    quoted = ["concat('\"', Description, '\"')" if c == "Description" else c for c in RAW_COLUMNS]
    whole = ", ".join(f"coalesce({c}, '')" for c in quoted)
    line = f"case when {SHORT} then concat_ws(',', InvoiceNo, 'a, b') when {LONG} then concat(l, ',more, \"and, more\"') else l end"
    lines_of = foreign(spark, folder).selectExpr("InvoiceNo", f"concat_ws(',', {whole}) as l").selectExpr(f"{line} as value")
    lines_of.write.option("encoding", "ISO-8859-1").text(path)
    return O.read_csv_text(spark, path, header=False)


@query("broken_csv", f"{FOREIGN_ROW} where {WIDTHS}")
def read_broken_csv(spark, folder):
    """Lines of another width give no order."""
    return O.typed_orders(broken_csv(spark, folder))


@query("broken_csv_rejects", f"""with {RAW}, all_lines as (select *, cast(InvoiceNo as bigint) as i from retail_raw)
select case when i % 43 = 0 then '3 fields instead of 8' when i % 47 = 0 then '10 fields instead of 8' else 'untyped' end as reason,
  case when i % 43 = 0 then concat(InvoiceNo, ',a, b') end as short_record, count(*) as n
from all_lines where i % 43 = 0 or i % 47 = 0 or {BAD} group by 1, 2""")
def broken_csv_rejects(spark, folder):
    """Lines of another width as they stand, and lines with fields of the wrong type, with the reason."""
    rejected = O.rejected_orders(broken_csv(spark, folder))
    short = F.when(F.col("reason") == "3 fields instead of 8", F.col("record"))
    return rejected.groupBy("reason", short.alias("short_record")).agg(F.count(F.lit(1)).alias("n"))


def broken_json(spark, folder):
    """JSON lines, some of them cut short."""
    path = fresh_path(spark, "broken-json")
    cut = f"case when {SHORT} then substring(value, 1, {CUT}) else value end"
    foreign(spark, folder).selectExpr("InvoiceNo", f"{json_of(RAW_COLUMNS)} as value").selectExpr(f"{cut} as value").write.text(path)
    return O.read_json_text(spark, path, multi_line=False)


@query("broken_json", f"{FOREIGN_ROW} where cast(InvoiceNo as bigint) % 43 <> 0")
def read_broken_json(spark, folder):
    """Lines that are cut give no order."""
    return O.typed_orders(broken_json(spark, folder))


@query("broken_json_rejects", f"""with {RAW}, all_lines as (select *, cast(InvoiceNo as bigint) as i from retail_raw)
select case when i % 43 = 0 then 'not JSON' else 'untyped' end as reason,
  case when i % 43 = 0 then left('{{"InvoiceNo": "' || InvoiceNo || '", "StockCode"', {CUT}) end as record, count(*) as n
from all_lines where i % 43 = 0 or {BAD} group by 1, 2""")
def broken_json_rejects(spark, folder):
    """Cut lines as they stand, and lines with fields of the wrong type."""
    return O.rejected_orders(broken_json(spark, folder)).groupBy("reason", "record").agg(F.count(F.lit(1)).alias("n"))


def foreign_message_files(spark, folder):
    """Messages of a producer that writes microseconds, and for some invoices leaves fields out, as text files."""
    path = fresh_path(spark, "foreign-messages")
    whole, empty, part = json_of(RAW_COLUMNS), "'{}'", json_of(["InvoiceNo", "Quantity"])
    kind = f"case when InvoiceNo % 23 = 0 then {empty} when InvoiceNo % 19 = 0 then {part} else {whole} end"
    warehouse.write_messages(foreign(spark, folder).selectExpr(f"{kind} as value"), path)
    return path


def foreign_messages(spark, folder):
    return spark.read.text(foreign_message_files(spark, folder))


WHOLE = f"not ({BAD}) and cast(InvoiceNo as bigint) % 23 <> 0 and cast(InvoiceNo as bigint) % 19 <> 0"


@query("foreign_messages", f"{FOREIGN_ROW} where {WHOLE}")
def parse_foreign_messages(spark, folder):
    """ST1: messages with microseconds."""
    return stream.parse_orders(foreign_messages(spark, folder))


@query("foreign_dead_letters", f"with {RAW} select count(*) as n from retail_raw where not ({WHOLE})")
def foreign_dead_letters(spark, folder):
    """ST1: messages without an invoice or amounts, or with fields that aren't of their type."""
    return stream.dead_letters(foreign_messages(spark, folder)).agg(F.count(F.lit(1)).alias("n"))


SCANNED = f"{ROW}, cast(cents as double) / 100 as Revenue, {PARTS}"


@query("clean_orders_scan", with_lines(f"select {SCANNED} from lines"))
def clean_orders_scan(spark, folder):
    """S2, P1, P7, P8."""
    return O.scan_clean_orders(raw(spark, folder))


@query("clean_orders_newest", with_lines(f"""select {SCANNED} from (select * from lines
  order by InvoiceDate desc, InvoiceNo, StockCode, Quantity, UnitPrice, CustomerID limit 10000)"""))
def clean_orders_newest(spark, folder):
    """S2 with its limit, S3: the newest 10,000 lines."""
    return O.scan_sample(raw(spark, folder))


CAPPED = "Quantity <= 100 and UnitPrice <= 100 and Country is not null"


@query("training_sample", with_lines(f"""select {ROW}, cast(cents as double) / 100 as Revenue
from (select * from lines where {CAPPED} order by {ROW_KEY} limit 50000)"""))
def training_sample(spark, folder):
    """The repeatable pick of 50,000 training lines."""
    return features.training_sample(raw(spark, folder))


@query("export_sample", with_lines(f"select {ROW} from lines order by {ROW_KEY} limit 1000"))
def export_sample(spark, folder):
    """A repeatable pick of 1,000 lines."""
    return O.export_sample(raw(spark, folder).transform(cleaning.valid_sales))


@query("daily_json", with_lines("""
select cast(Date as varchar) as Date, count(*) as total_orders, cast(sum(cents) as double) / 100 as total_revenue
from lines group by Date"""))
def daily_json(spark, folder):
    """Metrics of every date written as nested JSON and read back."""
    counts = lines(spark, folder, "InvoiceDate").groupBy("Date")
    nested = counts.agg(F.struct(kpi.rows().alias("orders"), kpi.total_revenue().alias("revenue")).alias("total"))
    path = O.write_json_doc(nested, fresh_path(spark, "doc"), "daily")
    read = spark.read.schema("Date date, total struct<orders: bigint, revenue: decimal(18,2)>").json(path)
    return read.select("Date", F.col("total.orders").alias("total_orders"), F.col("total.revenue").alias("total_revenue"))


@query("appended_metrics", with_lines("""
select cast(Date as varchar) as Date, cast(sum(cents) as double) / 100 as revenue, count(*) as orders,
  cast(null as bigint) as best_hour from lines group by Date
union all select cast(Date as varchar), null, null, arg_min(Hour, (-cents, Hour)) from (
  select Date, Hour, sum(cents) as cents from lines group by Date, Hour) group by Date"""))
def appended_metrics(spark, folder):
    """Two runs append to one table, the second with a new column; the first is tried twice."""
    sold = lines(spark, folder, "InvoiceDate")
    path = fresh_path(spark, "metrics")
    daily = sold.groupBy("Date").agg(kpi.total_revenue().alias("revenue"), kpi.rows().alias("orders"))
    O.append_metrics(daily, path, "first")
    O.append_metrics(kpi.peak_hour(sold).select("Date", F.col("peak_hour").alias("best_hour")), path, "second")
    O.append_metrics(daily, path, "first")
    return O.read_metrics(spark, path).drop("processing_timestamp", "run_id")


@query("file_rows", " union all ".join(
    f"select '{n}.parquet' as file_name, count(*) as rows from {n}" for n in warehouse.TABLES))
def file_rows(spark, folder):
    """Rows per file of the given tables."""
    counted = [O.file_rows(spark, f"{folder}/{n}.parquet", s) for n, s in warehouse.TABLES.items()]
    return reduce(DataFrame.unionByName, counted)


def inventory(spark, folder):
    return reduce(DataFrame.unionByName, [O.file_inventory(spark, f"{folder}/{n}.parquet", s) for n, s in warehouse.TABLES.items()])


@query("table_inventory", " union all ".join(
    f"select '{n}.parquet' as file_name, count(*) as rows, true as has_size, true as has_time from {n} having count(*) > 0" for n in warehouse.TABLES))
def table_inventory(spark, folder):
    """Rows, size and time of change of every file of the given tables."""
    files = inventory(spark, folder)
    known = [(F.col("bytes") > F.col("rows") / 8).alias("has_size"), (F.col("modified") >= F.lit("1970-01-01").cast("timestamp")).alias("has_time")]
    return files.select("file_name", "rows", *known)


@query("folder_totals", f"""with counted as ({" union all ".join(f"select count(*) as rows from {n} having count(*) > 0" for n in warehouse.TABLES)})
select count(*) as files, cast(sum(rows) as bigint) as rows from counted union all select count(*), cast(sum(rows) as bigint) from counted""")
def folder_totals(spark, folder):
    """Files and rows of the one folder and of all."""
    return O.folder_totals(inventory(spark, folder)).select("files", "rows")


EXPECTED = [*warehouse.TABLES, "returns", "shipments"]


@query("file_completeness", " union all ".join(
    f"select '{n}.parquet' as file_name, " + ("'present'" if n in warehouse.TABLES else "'missing'") + " as status" for n in EXPECTED))
def file_completeness(spark, folder):
    """Which of the expected files are there."""
    expected = spark.createDataFrame([(f"{n}.parquet",) for n in EXPECTED], "file_name string")
    return O.completeness(inventory(spark, folder), expected)
