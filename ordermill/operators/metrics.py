"""Levels, alerts and reports over tables of metric readings and job stages.

Readings are rows ``reading_id, ts, metric, value``.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions.picking import latest_n, top_n_by


def level(value: Column, metric: Column, thresholds: dict = S.METRIC_THRESHOLDS) -> Column:
    """critical, warning or healthy by the metric's (warning, critical) thresholds; unknown for a null value."""
    warning, critical = [F.lit(t) for t in S.DEFAULT_THRESHOLDS]
    for name, (w, c) in thresholds.items():
        warning = F.when(metric == name, F.lit(w)).otherwise(warning)
        critical = F.when(metric == name, F.lit(c)).otherwise(critical)
    known = F.when(value >= critical, "critical").when(value >= warning, "warning").otherwise("healthy")
    return F.when(value.isNull(), "unknown").otherwise(known)


def status_level(readings: DataFrame, thresholds: dict = S.METRIC_THRESHOLDS) -> DataFrame:
    return readings.withColumn("status", level(F.col("value"), F.col("metric"), thresholds))


def metric_alerts(readings: DataFrame, thresholds: dict = S.METRIC_THRESHOLDS, system: dict = S.SYSTEM_METRICS) -> DataFrame:
    """One alert of type system per reading of a system metric that is a warning or critical.

    ``system`` names those metrics as messages do; other metrics, such as response times, have a status but raise no
    alert. Works on batches and streams.
    """
    names = F.create_map(*[F.lit(x) for pair in system.items() for x in pair])
    message = F.concat(
        F.lit("High "), F.try_element_at(names, F.col("metric")), F.lit(" usage: "), F.col("value").cast("decimal(18,2)").cast("string"), F.lit("%")
    )
    return (
        status_level(readings, thresholds)
        .where(F.col("metric").isin(*system) & F.col("status").isin("warning", "critical"))
        .select("reading_id", F.lit("system").alias("type"), F.col("status").alias("level"), message.alias("message"), "ts")
    )


def service_alerts(states: DataFrame, kind: str = "api", name: str = "ML API") -> DataFrame:
    """Alerts on states ``reading_id, ts, state, error`` of a service: offline is critical, an error a warning."""
    offline = F.col("state") == "offline"
    said = F.concat(F.lit(f"{name} error: "), F.coalesce("error", F.lit("Unknown error")))
    return states.where(F.col("state").isin("offline", "error")).select(
        "reading_id",
        F.lit(kind).alias("type"),
        F.when(offline, "critical").otherwise("warning").alias("level"),
        F.when(offline, F.lit(f"{name} is offline")).otherwise(said).alias("message"),
        "ts",
    )


def alert_breakdown(*alerts: DataFrame) -> DataFrame:
    """Number of alerts by type over several tables of alerts, and their total in the row ``all``."""
    every = reduce(DataFrame.unionByName, alerts).groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    total = every.rollup("type").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("alerts"))
    return total.select(F.coalesce("type", F.lit("all")).alias("type"), "alerts")


def session_report(readings: DataFrame, thresholds: dict = S.METRIC_THRESHOLDS) -> DataFrame:
    """Checks, mean, maximum and alerts per metric, and over all in the row ``all``.

    The last row is made of the rows per metric, not of the readings again.
    """
    status = F.col("status")
    metrics = (
        status_level(readings, thresholds)
        .groupBy("metric")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("value").alias("measured"),
            F.sum("value").alias("total"),
            F.max("value").alias("highest"),
            F.count_if(status.isin("warning", "critical")).alias("raised"),
            F.count_if(status == "critical").alias("critical"),
        )
    )
    return (
        metrics.rollup("metric")
        .agg(
            F.sum("n").alias("checks"),
            F.round(F.try_divide(F.sum("total"), F.sum("measured")), 1).alias("avg_value"),
            F.round(F.max("highest"), 1).alias("max_value"),
            F.sum("raised").alias("alerts"),
            F.sum("critical").alias("critical_alerts"),
        )
        .withColumn("metric", F.coalesce("metric", F.lit("all")))
    )


def latest_metrics(readings: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest readings."""
    return latest_n(readings, n, "ts", F.desc("reading_id"))


def latest_per_metric(readings: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest readings of each metric."""
    return top_n_by(readings, n, ["metric"], F.desc("ts"), F.desc("reading_id"))


def run_report(stages: DataFrame, total_tasks: int = 5) -> DataFrame:
    """Success of a scheduled run from one row ``stage, rows, file_created`` per stage.

    A stage succeeds if it has rows; ``file_created`` says whether its output could be read back with rows in it, and
    is null for stages that write nothing.
    """
    n, good = F.count(F.lit(1)), F.count_if(F.col("rows") > 0)
    return stages.agg(
        F.lit(total_tasks).alias("total_tasks"),
        good.alias("successful_tasks"),
        F.count_if("file_created").alias("data_files_created"),
        F.when(good == n, "success").otherwise("partial_success").alias("overall_status"),
    )
