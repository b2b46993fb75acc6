"""Run log: one row per run and long tables of its parameters, metrics and class report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import records

RUNS = (
    "run_id string, batch_id string, model_type string, status string, started_at timestamp, model_path string"
)
PARAMS = "run_id string, name string, value string"
METRICS = "run_id string, name string, value double"
REPORTS = "run_id string, class string, precision double, recall double, f1 double, support bigint"
FINISHED = "FINISHED"


def _append(spark: SparkSession, rows: list[tuple], schema: str, name: str) -> None:
    if rows:
        records.publish(spark, name, schema, rows)


def log_run(
    spark: SparkSession,
    prefix: str,
    run_id: str,
    batch_id: str,
    model_type: str,
    started_at: datetime,
    model_path: str,
    params: dict[str, object],
    metrics: dict[str, float | None],
    report: list[tuple],
    status: str = FINISHED,
) -> None:
    """Append one run. The run row comes last: a run that is listed is complete."""
    _append(spark, [(run_id, k, str(v)) for k, v in params.items()], PARAMS, f"{prefix}_run_params")
    _append(
        spark,
        [(run_id, k, None if v is None else float(v)) for k, v in metrics.items()],
        METRICS,
        f"{prefix}_run_metrics",
    )
    _append(spark, [(run_id, *row) for row in report], REPORTS, f"{prefix}_run_reports")
    _append(spark, [(run_id, batch_id, model_type, status, started_at, model_path)], RUNS, f"{prefix}_runs")


def ranked_runs(runs: DataFrame, metrics: DataFrame, metric: str, batch_id: str | None = None) -> DataFrame:
    """Finished runs with the given metric as `metric_value`, all batches unless one is named."""
    finished = runs.where(F.col("status") == FINISHED)
    if batch_id is not None:
        finished = finished.where(F.col("batch_id") == batch_id)
    values = metrics.where(F.col("name") == metric).select("run_id", F.col("value").alias("metric_value"))
    return finished.join(values, "run_id")


def best_run(runs: DataFrame, metrics: DataFrame, metric: str = "test_f1", batch_id: str | None = None) -> DataFrame:
    """The finished run with the highest metric; the smallest run id among equals."""
    return (
        ranked_runs(runs, metrics, metric, batch_id)
        .orderBy(F.desc_nulls_last("metric_value"), "run_id")
        .limit(1)
    )


def require_best_run(
    spark: SparkSession, prefix: str, metric: str = "test_f1", batch_id: str | None = None
) -> tuple[str, str, dict[str, float]]:
    """Run id, model type and metrics of the best run; ValueError without a run log or a finished run."""
    if not spark.catalog.tableExists(f"{prefix}_runs"):
        raise ValueError(f"Run log not found: {prefix}_runs")
    runs, metrics = run_tables(spark, prefix)
    row = best_run(runs, metrics, metric, batch_id).first()
    if row is None:
        raise ValueError(f"{prefix}_runs has no run that ended well")
    values = metrics.where(F.col("run_id") == row.run_id).select("name", "value").collect()
    return row.run_id, row.model_type, {v.name: v.value for v in values}


def compare_models(runs: DataFrame, metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row per run in training order, one column per metric."""
    wide = (
        metrics.where(F.col("name").isin(names))
        .groupBy("run_id")
        .agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])
    )
    return (
        runs.select("run_id", "model_type", "started_at")
        .join(wide, "run_id", "left")
        .orderBy("started_at", "run_id")
    )


def run_tables(spark: SparkSession, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Runs and metrics logged so far, by any session."""
    return records.read(spark, f"{prefix}_runs", RUNS), records.read(spark, f"{prefix}_run_metrics", METRICS)
