"""Readers and writers of order lines, metrics and samples."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions import expressions as E
from ordermill.functions.picking import latest_n, sample_n
from ordermill.operators.cleaning import valid_sales, with_revenue, with_time_parts
from ordermill.schema import RAW_COLUMNS, RAW_ORDER_LINE

CSV = {
    "header": True,
    "encoding": "ISO-8859-1",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}


def as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


#: Holds a record that a reader could not take apart, as it stands in the file.
BROKEN = "_broken"


def _with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType([*as_text(schema).fields, T.StructField(BROKEN, T.StringType())])


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType = RAW_ORDER_LINE, header: bool = True) -> DataFrame:
    """Latin-1 files with every field as text. Lines with too few or too many fields are whole in ``_broken``."""
    options = CSV | {"header": header, "columnNameOfCorruptRecord": BROKEN, "columnPruning": False}
    return spark.read.schema(_with_broken(schema)).options(**options).csv(path)


def read_json_text(spark: SparkSession, path: str, multi_line: bool = True, schema: T.StructType = RAW_ORDER_LINE) -> DataFrame:
    """JSON arrays of orders, or with ``multi_line=False`` one order per line, with every field as text.

    Records that aren't JSON are in ``_broken``: a line, or with ``multi_line`` the whole file.
    """
    reader = spark.read.schema(_with_broken(schema)).option("columnNameOfCorruptRecord", BROKEN)
    return reader.json(path, multiLine=multi_line)


def whole_records(text: DataFrame) -> DataFrame:
    """Without the broken records of a text reader."""
    return text.where(F.col(BROKEN).isNull()).drop(BROKEN) if BROKEN in text.columns else text


def typed_orders(text: DataFrame, schema: T.StructType = RAW_ORDER_LINE) -> DataFrame:
    """Text fields as their types; a field that isn't of its type is null, a broken record gives no row.

    Works on streams too.
    """
    return whole_records(text).select(*[E.typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def untyped_fields(schema: T.StructType = RAW_ORDER_LINE) -> Column:
    """Names of the fields that hold something which isn't of their type."""
    bad = [
        F.when((F.trim(f.name) != "") & E.typed(F.col(f.name), f.dataType).isNull(), f.name)
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return F.array_compact(F.array(*bad))


def _broken_reason(schema: T.StructType) -> Column:
    """What is wrong with a broken record: how many fields a CSV line has, or that it isn't JSON."""
    line = F.trim(BROKEN)
    outside_quotes = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*+"', "")
    fields = (F.regexp_count(outside_quotes, F.lit(",")) + 1).cast("string")
    counted = F.concat(fields, F.lit(f" fields instead of {len(schema)}"))
    return F.when(F.substring(line, 1, 1).isin("{", "["), "not JSON").otherwise(counted)


def rejected_orders(text: DataFrame, schema: T.StructType = RAW_ORDER_LINE) -> DataFrame:
    """Records that ``typed_orders`` leaves out or nulls a field of, as text.

    ``reason`` is what is wrong with a broken record, which is whole in ``record``, or ``untyped``; then
    ``rejected_fields`` names the fields. Every record of the files is either typed or broken here.
    """
    if BROKEN not in text.columns:
        text = text.withColumn(BROKEN, F.lit(None).cast("string"))
    broken = F.col(BROKEN).isNotNull()
    fields = F.when(broken, F.array().cast("array<string>")).otherwise(untyped_fields(schema))
    marked = text.withColumn("rejected_fields", fields)
    reason = F.when(broken, _broken_reason(schema)).otherwise("untyped")
    return marked.where(broken | (F.size("rejected_fields") > 0)).withColumn("reason", reason).withColumnRenamed(BROKEN, "record")


def read_orders_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_ORDER_LINE) -> DataFrame:
    """Headered Latin-1 files; a field that does not fit its type is null, and a line of another width is left out
    (``rejected_orders`` tells which)."""
    return typed_orders(read_csv_text(spark, path, schema), schema)


def read_clean_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Cleaned lines back from CSV, with Date taken from the re-typed InvoiceDate."""
    return read_orders_csv(spark, path, schema).withColumn("Date", F.to_date("InvoiceDate"))


def read_orders_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Files that hold one JSON array of orders each, or with ``multi_line=False`` one order per
    line, which Spark can split among tasks."""
    return typed_orders(read_json_text(spark, path, multi_line))


def write_csv(df: DataFrame, folder: str, run_id: str) -> str:
    """Write one CSV data set per run and return its path."""
    path = f"{folder}/{run_id}"
    df.write.mode("overwrite").options(**CSV).csv(path)
    return path


def write_json_doc(df: DataFrame, folder: str, run_id: str) -> str:
    """Write nested rows as JSON and return the path."""
    path = f"{folder}/{run_id}"
    df.write.mode("overwrite").json(path)
    return path


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Add the rows of a run with the time of processing; the same run again replaces its rows.

    Later runs may bring new columns.
    """
    rows = metrics.withColumn("processing_timestamp", F.current_timestamp())
    rows.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def export_sample(df: DataFrame, n: int = 1000) -> DataFrame:
    return sample_n(df, n, E.row_key())


def scan_clean_orders(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Valid sales, or the newest ``limit`` of them, with Revenue and time parts."""
    clean = raw.select(*RAW_COLUMNS).transform(valid_sales)
    if limit is not None:
        ties = ["InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID"]
        clean = latest_n(clean, limit, "InvoiceDate", *[F.col(c).asc() for c in ties])
    return clean.transform(with_revenue).transform(with_time_parts)


def scan_sample(raw: DataFrame) -> DataFrame:
    return scan_clean_orders(raw, 10000)


def as_messages(orders: DataFrame) -> DataFrame:
    """Orders as JSON payloads in the column ``value``."""
    return orders.select(F.to_json(F.struct("*"), JSON).alias("value"))


def publish_orders(orders: DataFrame, path: str | None = None, **kafka) -> None:
    """Send all orders, to text files under ``path`` or to Kafka with the given options."""
    writer = as_messages(orders).write
    if path is not None:
        writer.mode("append").text(path)
    else:
        writer.format("kafka").options(**kafka).save()


def file_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows per parquet file under ``path``."""
    rows = spark.read.schema(schema).parquet(path)
    return rows.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("rows"))


def file_inventory(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``folder, file_name, rows, bytes, modified`` of every parquet file under ``path`` that has rows, from its rows' metadata.

    No column is read: counts come from the files' own footers.
    """
    meta = F.col("_metadata")
    found = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path).select(meta.alias("m"))
    whole = F.regexp_extract(F.col("m.file_path"), "([^/]+)/[^/]+$", 1)
    return found.groupBy(whole.alias("folder"), F.col("m.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("m.file_size").alias("bytes"), F.max("m.file_modification_time").alias("modified")
    )


def folder_totals(files: DataFrame) -> DataFrame:
    """Files, rows, bytes and newest change of each folder of a ``file_inventory``, and of all in the row ``all``."""
    totals = files.rollup("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"),
        F.grouping("folder").alias("_all"),
    )
    return totals.where("_all = 0 or files > 0").withColumn("folder", F.when(F.col("_all") == 1, "all").otherwise(F.col("folder"))).drop("_all")


def completeness(files: DataFrame, expected: DataFrame, stale: str | None = None) -> DataFrame:
    """``file_name, status`` for every expected name: ``missing``, ``stale`` (last changed before that time) or ``present``.

    A file that is written in parts is there when any part is.
    """
    seen = files.groupBy("file_name").agg(F.max("modified").alias("modified"))
    old = F.lit(False) if stale is None else F.col("modified") < F.lit(stale).cast("timestamp")
    status = F.when(F.col("modified").isNull(), "missing").when(old, "stale").otherwise("present")
    return expected.select("file_name").distinct().join(seen, "file_name", "left").select("file_name", status.alias("status"))
