"""The scheduled job: clean, compute the day's KPIs, train, report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.functions.picking import sample_n
from ordermill.operators.cleaning import clean_for_schedule
from ordermill.operators.features import FEATURES, label_dictionary, label_encode, train_test_split
from ordermill.operators.kpi import daily_document
from ordermill.operators.metrics import run_report
from ordermill.operators.model import load_model, save_model, train_revenue_model
from ordermill.operators.quality import observe_rows
from ordermill.operators.scoring import regression_metrics
from ordermill.session import settled
from ordermill.sources.orders import write_json_doc


def run_scheduled(
    raw: DataFrame, folder: str, total_tasks: int = 5, sample_size: int | None = None, **forest
) -> tuple[DataFrame, DataFrame]:
    """Run all stages into ``folder``; returns the stage table and the run report.

    The cleaned lines are written once, and both the KPIs and the training read that table. It has a folder for each
    date, whose lines are first brought together (those of a very large date in several files), so a report on one
    date reads that folder alone. Rows are counted while they are written, and every output is read back before it
    counts as created. ``sample_size`` bounds the lines that the forest learns from; it has no least leaf size here.
    """
    spark = raw.sparkSession
    read, read_rows = observe_rows(raw, "read")
    cleaned, cleaned_rows = observe_rows(clean_for_schedule(read), "cleaned")
    dates = cleaned.hint("rebalance", "Date").sortWithinPartitions("Date", "InvoiceDate")
    dates.write.mode("overwrite").partitionBy("Date").parquet(f"{folder}/cleaned")
    lines = spark.read.schema(cleaned.schema).parquet(f"{folder}/cleaned")

    latest = lines.agg(F.max("Date")).first()[0]  # the names of the folders tell
    metrics, metric_rows = observe_rows(daily_document(lines, latest), "metrics")
    document = write_json_doc(metrics, f"{folder}/processed", "daily_metrics")

    labelled = lines if sample_size is None else settled(sample_n(lines, sample_size, E.row_key()))
    dictionary = label_dictionary(labelled, S.CATEGORY_FEATURES)
    train, test = train_test_split(labelled)
    encoded = label_encode(train, dictionary, S.CATEGORY_FEATURES).select(*FEATURES, "Revenue", E.row_key().alias("row_key"))
    model = train_revenue_model(encoded, **({"min_leaf": 1} | forest))
    save_model(model, dictionary, f"{folder}/models", "cleaned order lines")
    loaded, encoders, _ = load_model(spark, f"{folder}/models")
    scored = loaded.transform(label_encode(test, encoders, S.CATEGORY_FEATURES))
    quality = regression_metrics(scored)
    quality.write.mode("overwrite").json(f"{folder}/model_quality")
    samples = spark.read.schema("samples bigint").json(f"{folder}/model_quality").first()

    stages = [
        ("read_orders", read_rows.get["rows"], None),
        ("clean_data", cleaned_rows.get["rows"], not lines.isEmpty()),
        ("batch_process_data", metric_rows.get["rows"], not spark.read.text(document).isEmpty()),
        ("train_model", samples["samples"] if samples else 0, not loaded.nodes.isEmpty()),
    ]
    table = spark.createDataFrame(stages, "stage string, rows bigint, file_created boolean")
    return table, run_report(table, total_tasks)
