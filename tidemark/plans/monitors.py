"""Refresh the monitors of one scored log, or of every log found in the catalog."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.numeric import is_positive
from tidemark.operators import monitor
from tidemark.operators.metrics import confusion_metrics
from tidemark.session import cut_lineage
from tidemark.plans.monitor_state import KEEP_SECONDS, PROBABILITY, is_partitioned, refresh_incremental, window_bounds
from tidemark.sources.feature_table import replace_table, retire
from tidemark.sources.scored_log import DATE_COLUMN
from tidemark.sources.tables import find_tables

RESULT = "table string, status string, error string"
OK, ERROR = "ok", "error"


@dataclass
class MonitorTables:
    """Metric and alert tables of one log."""

    profile: DataFrame
    drift: DataFrame
    quality: DataFrame | None
    alerts: DataFrame
    auc: DataFrame | None = None


def _label(config: Config):
    target = F.col(config.target)
    return F.when(target.isNotNull(), is_positive(target, config.positive).cast("int"))


def monitor_log(log: DataFrame, baseline: DataFrame, config: Config, ts: str = "inference_ts") -> MonitorTables:
    """Profiles, drift, quality and alerts of a scored log. Quality needs the label in the log."""
    numeric = [c for c in config.numeric if c in log.columns]
    categorical = [c for c in config.categorical if c in log.columns]
    outputs = [c for c in ("prediction",) if c in log.columns]
    profiled = monitor.profile(log, ts, numeric, categorical + outputs, config.granularity)
    # a row per window and column, stored, so that alerts do not read the log again
    drifted = cut_lineage(monitor.drift(baseline, log, ts, numeric, categorical, config.granularity))
    alerts = monitor.drift_alerts(drifted, config.psi_threshold)
    by_window = areas = None
    if config.target in log.columns:
        predicted = is_positive(F.col("prediction"), config.positive).cast("int")
        by_window = cut_lineage(monitor.quality_by_window(log, ts, _label(config), predicted, config.granularity))
        if {"prediction", config.target} <= set(baseline.columns):
            base_f1 = confusion_metrics(baseline, _label(config), predicted).select("f1").scalar()
            falls = monitor.quality_alerts(by_window, base_f1, config.target, config.f1_drop_threshold)
            alerts = alerts.unionByName(falls)
        if PROBABILITY in log.columns:
            areas = monitor.auc_by_window(log, ts, _label(config), PROBABILITY, config.target, config.granularity)
    return MonitorTables(profiled, drifted, by_window, alerts, areas)


def _parts(tables: MonitorTables, target: str) -> dict[str, DataFrame]:
    parts = {"profile_metrics": tables.profile, "drift_metrics": tables.drift, "alerts": tables.alerts}
    if tables.quality is not None:
        figures = monitor.quality_metrics(tables.quality, target)
        parts["quality_metrics"] = figures if tables.auc is None else figures.unionByName(tables.auc)
    return parts


def write_monitors(tables: MonitorTables, log_name: str, target: str, grace: float = KEEP_SECONDS) -> None:
    """Put new versions of the metric tables that belong to a log in place; readers see the former until one is whole.

    A frame opened before goes on reading the former version, which is dropped by the first refresh after `grace` seconds.
    """
    base = log_name.replace("`", "")
    for suffix, df in _parts(tables, target).items():
        name = f"{base}_{suffix}"
        replace_table(df, name)
        retire(df.sparkSession, name, grace=grace)


def refresh_days(
    log: DataFrame, baseline: DataFrame, config: Config, log_name: str, first: date, last: date, ts: str = "inference_ts", grace: float = KEEP_SECONDS
) -> None:
    """Refresh the windows that hold some day from `first` to `last`; the metrics of other windows stay as they are.

    Windows are refreshed whole: where they are longer than a day, or begin within one, the days beside are read too.
    Only the partitions of these days are read.
    """
    spark = log.sparkSession
    start, end = window_bounds(spark, first, last, config.granularity)
    day = F.col(DATE_COLUMN).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    rows = log.where(day & (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    tables = monitor_log(rows, baseline, config, ts)
    base = log_name.replace("`", "")
    for suffix, df in _parts(tables, config.target).items():
        name = f"{base}_{suffix}"
        if spark.catalog.tableExists(name):
            window = F.col(monitor.WINDOW)
            others = spark.table(name).where(window.isNull() | (window < F.lit(start)) | (window >= F.lit(end)))
            df = others.unionByName(df)
        replace_table(df, name)
        retire(spark, name, grace=grace)


def refresh_all(spark: SparkSession, log_name: str, refresh: Callable[[str], None]) -> DataFrame:
    """Run `refresh` for every table of that name in any database; a failure is recorded and the rest go on."""
    found, unreadable = find_tables(spark, log_name)
    rows: list[tuple[str, str, str | None]] = [(name, ERROR, text) for name, text in unreadable]
    for name in found:
        try:
            refresh(name)
            rows.append((name, OK, None))
        except Exception as error:
            rows.append((name, ERROR, str(error)))
    return spark.createDataFrame(rows, RESULT)


def refresh_configured(spark: SparkSession, config: Config, log_name: str) -> DataFrame:
    """Refresh every log of that name against the baseline table that the settings name.

    Of a log partitioned by day only days with new files are read; another log is read whole.
    """
    if not config.baseline_table:
        raise ValueError("The settings name no baseline table")

    def refresh(name: str) -> None:
        baseline = spark.table(config.baseline_table)
        if is_partitioned(spark, name):
            refresh_incremental(spark, name, baseline, config)
        else:
            write_monitors(monitor_log(spark.table(name), baseline, config), name, config.target)

    return refresh_all(spark, log_name, refresh)


def refresh_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status") == OK).alias("n_ok"), F.count("*").alias("n_tables"))
