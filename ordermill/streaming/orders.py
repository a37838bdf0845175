"""Order streams: parsing, cleaning, scoring, alerts and windowed revenue.

The functions that take and return frames serve batches and streams alike. Sinks write each
micro-batch to a folder of its own under the batch id, so a batch that is run again after a
failure replaces its earlier output.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.operators.cleaning import clean_for_streaming, with_revenue
from ordermill.operators.scoring import score_orders
from ordermill.sources.orders import as_text


def read_order_stream(spark: SparkSession, path: str | None = None, files_per_batch: int = 1000, **kafka) -> DataFrame:
    """Payloads as they arrive in column ``value``: text files under ``path``, or Kafka."""
    if path is not None:
        return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    stream = spark.readStream.format("kafka").options(**kafka).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def _parsed(messages: DataFrame) -> DataFrame:
    """Payload with its order's ``typed`` fields, ``_reason`` where it is none, and the fields that are to blame.

    An order is JSON whose fields are of their types, with an invoice, a quantity and a price.
    """
    schema = T.StructType([*as_text(S.RAW_ORDER_LINE).fields, T.StructField("_corrupt", T.StringType())])
    order = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    fields = _once(messages, value=F.col("value"), o=order).select("value", "o.*", F.col("o").isNull().alias("_none"))
    typed = F.struct(*[E.typed(F.col(f.name), f.dataType).alias(f.name) for f in S.RAW_ORDER_LINE.fields])
    fields = _once(fields, typed=typed, **{c: F.col(c) for c in fields.columns})
    # told by plain conditions, which stay in generated code; names are put together only where a record is rejected
    blank = {name: F.coalesce(F.trim(name), F.lit("")) == "" for name in S.MESSAGE_COLUMNS}
    untyped = {
        f.name: F.coalesce(F.trim(f.name) != "", F.lit(False)) & F.col(f"typed.{f.name}").isNull()
        for f in S.RAW_ORDER_LINE.fields
        if not isinstance(f.dataType, T.StringType)
    }
    no_json = F.col("_none") | F.col("_corrupt").isNotNull()
    reason = F.when(no_json, "not JSON").when(reduce(or_, blank.values()), "missing").when(reduce(or_, untyped.values()), "untyped")
    named = lambda found: F.array_compact(F.array(*[F.when(c, name) for name, c in found.items()]))
    blamed = F.when(F.col("_reason") == "missing", named(blank)).when(F.col("_reason") == "untyped", named(untyped))
    return fields.withColumn("_reason", reason).withColumn("_fields", blamed).select("value", "typed", "_reason", "_fields")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Only ``columns``, each worked out once a row: filters and columns above refer to rows that a generator gives.

    In a plain select an optimizer may copy a costly expression, such as parsing, to each place that reads a part of it.
    """
    return df.select(F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def parse_orders(messages: DataFrame) -> DataFrame:
    return _orders(_parsed(messages))


def _orders(parsed: DataFrame) -> DataFrame:
    return parsed.where("_reason is null").select("typed.*")


def dead_letters(messages: DataFrame) -> DataFrame:
    """Payloads that ``parse_orders`` leaves out."""
    return _rejects(_parsed(messages)).select("value")


def _rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where("_reason is not null").select("value", F.col("_reason").alias("reason"), F.col("_fields").alias("rejected_fields"))


def order_sinks(messages: DataFrame, folder: str) -> StreamingQuery:
    """Every payload once: orders to ``folder/orders``, the others with reason and fields to ``folder/dead_letters``.

    A micro-batch is parsed once for both. A batch that fails between its two outputs is run again and replaces what
    it has written.
    """
    return write_batches(_parsed(messages), {"orders": _orders, "dead_letters": _rejects}, folder)


def stream_revenue(orders: DataFrame) -> DataFrame:
    return orders.transform(with_revenue)


def stream_clean(orders: DataFrame) -> DataFrame:
    return clean_for_streaming(orders)


def high_value_alerts(orders: DataFrame, limit: float = S.HIGH_VALUE_REVENUE) -> DataFrame:
    return orders.where(F.col("Revenue") > limit)


def stream_score(orders: DataFrame, model=None, encoders: DataFrame | None = None) -> DataFrame:
    """Orders with actual and predicted revenue; without a model with the actual only.

    The model sees quantity and price, hour 14 and weekday 2, and the default month and country.
    """
    priced = stream_revenue(orders).select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "Revenue")
    if model is None:
        return priced.withColumn("predicted_revenue", F.lit(None).cast("double"))
    requests = priced.withColumnsRenamed({"Quantity": "quantity", "UnitPrice": "unit_price"})
    scored = score_orders(requests.withColumns({"hour": F.lit(14), "day_of_week": F.lit(2)}), model, encoders)
    return scored.select(
        "InvoiceNo",
        "StockCode",
        F.col("quantity").alias("Quantity"),
        F.col("unit_price").alias("UnitPrice"),
        "Revenue",
        F.col("predicted_revenue").cast("double").alias("predicted_revenue"),
    )


def windowed_revenue(orders: DataFrame, length: str = "1 hour", slide: str | None = None, lateness: str = "10 minutes") -> DataFrame:
    """Revenue, orders and alerts per event-time window."""
    late = orders.withWatermark("InvoiceDate", lateness) if orders.isStreaming else orders
    return (
        late.groupBy(F.window("InvoiceDate", length, slide))
        .agg(
            F.sum("Revenue").cast(S.MONEY).alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
            F.count_if(F.col("Revenue") > S.HIGH_VALUE_REVENUE).alias("alerts"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "revenue", "orders", "alerts")
    )


def session_revenue(orders: DataFrame, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Revenue and orders of each customer's sessions: orders that follow each other within the gap.

    On a stream, sessions that meet are merged in the state, and one comes out, once and for all, when the watermark
    has passed its end.
    """
    late = orders.withWatermark("InvoiceDate", lateness) if orders.isStreaming else orders
    return (
        late.groupBy("CustomerID", F.session_window("InvoiceDate", gap))
        .agg(F.sum("Revenue").cast(S.MONEY).alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .select("CustomerID", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "revenue", "orders")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of finished rows to a parquet table."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batches(stream: DataFrame, sinks: dict, folder: str, mode: str = "append") -> StreamingQuery:
    """Run each ``name: transform`` of ``sinks`` on every micro-batch, into ``folder/name``.

    A micro-batch is kept while it is written where more than one sink reads it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) > 1:
            batch.persist()
        try:
            for name, transform in sinks.items():
                out = transform(batch).write.mode("overwrite")
                out.parquet(f"{folder}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def latest_rows(written: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the last batch for every key, for tables written in update mode."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    ranked = written.withColumn("_place", F.row_number().over(newest))
    return ranked.where(F.col("_place") == 1).drop("_place", "batch_id")
