"""Registered queries: profiles, drift, quality, alerts, refresh of many logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import monitor
from tidemark.operators.metrics import METRICS, auc_by, confusion_metrics
from tidemark.plans.monitor_state import refresh_incremental
from tidemark.plans.monitors import monitor_log, refresh_all, refresh_summary, write_monitors
from tidemark.plans.queries_models import confusion_sql
from tidemark.plans.registered import query, scratch_database
from tidemark.plans.subjects import (
    BASELINE_END,
    EVENT_LOG_SQL,
    EVENTS,
    baseline_and_current,
    event_log,
)
from tidemark.sources import scored_log

_E = f"""WITH e AS (SELECT *, strftime(inference_ts, '%Y-%m-%d') AS day FROM ({EVENT_LOG_SQL})),
  base AS (SELECT * FROM e WHERE inference_ts < TIMESTAMP '{BASELINE_END}'),
  cur AS (SELECT * FROM e WHERE inference_ts >= TIMESTAMP '{BASELINE_END}')"""


def _days(df: DataFrame, *rounded: str) -> DataFrame:
    """Window starts as text, figures rounded."""
    return df.withColumns(
        {monitor.WINDOW: F.date_format(monitor.WINDOW, "yyyy-MM-dd"), **{c: F.round(c, 6) for c in rounded}}
    )


_NUMBER_METRICS = {
    "count": "count(*)",
    "nulls": "count(*) - count(amount)",
    "null_rate": "avg(CASE WHEN amount IS NULL THEN 1e0 ELSE 0e0 END)",
    "distinct": "count(DISTINCT amount)",
    "mean": "avg(amount)",
    "std": "stddev_pop(amount)",
    "min": "min(amount)",
    "p25": "quantile_cont(amount, 25e-2)",
    "p50": "quantile_cont(amount, 5e-1)",
    "p75": "quantile_cont(amount, 75e-2)",
    "max": "max(amount)",
}
_TEXT_METRICS = {
    "count": "count(*)",
    "nulls": "count(*) - count({c})",
    "null_rate": "avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)",
    "distinct": "count(DISTINCT {c})",
}


def _profile_sql() -> str:
    parts = [
        f"SELECT day AS window_start, 'amount' AS \"column\", '{m}' AS metric, "
        f"round(CAST({sql} AS DOUBLE), 6) AS value FROM e GROUP BY day"
        for m, sql in _NUMBER_METRICS.items()
    ]
    parts += [
        f"SELECT day, '{c}', '{m}', round(CAST({sql.format(c=c)} AS DOUBLE), 6) FROM e GROUP BY day"
        for c in ("event_type", "prediction", "actual")
        for m, sql in _TEXT_METRICS.items()
    ]
    return " UNION ALL ".join(parts)


@query("q_profile_daily", f"{_E} {_profile_sql()}")
def profile_daily(spark: SparkSession, sf: str) -> DataFrame:
    found = monitor.profile(
        event_log(spark, sf), "inference_ts", ["amount"], ["event_type", "prediction", "actual"]
    )
    return _days(found, "value")


_TERM = "(greatest({q}, 1e-4) - greatest({p}, 1e-4)) * ln(greatest({q}, 1e-4) / greatest({p}, 1e-4))"
_EDGES = ", ".join(f"quantile_cont(amount, {i}e-1) AS q{i}" for i in range(1, 10))
_BIN = (
    "CASE WHEN amount IS NULL THEN '(null)' ELSE CAST("
    + " + ".join(f"(amount > q{i})::INTEGER" for i in range(1, 10))
    + " AS VARCHAR) END"
)
_TEXT_BIN = "coalesce(event_type, '(null)')"


def _psi_sql(bins: str, column: str, edges: bool) -> str:
    """Every window paired with every bin of either side."""
    source = f", (SELECT {_EDGES} FROM base)" if edges else ""
    return f"""
      SELECT d.day AS window_start, '{column}' AS "column", 'psi' AS metric,
        sum({_TERM.format(p="coalesce(p, 0e0)", q="coalesce(q, 0e0)")}) AS value
      FROM (SELECT DISTINCT day FROM cur) d
      CROSS JOIN (SELECT DISTINCT {bins} AS bin FROM e{source}) b
      LEFT JOIN (SELECT {bins} AS bin, count(*) / (SELECT count(*)::DOUBLE FROM base) AS p
                 FROM base{source} GROUP BY 1) x USING (bin)
      LEFT JOIN (SELECT day, bin, n / sum(n) OVER (PARTITION BY day)::DOUBLE AS q
                 FROM (SELECT day, {bins} AS bin, count(*) AS n FROM cur{source} GROUP BY 1, 2)) y
        ON y.bin = b.bin AND y.day = d.day
      WHERE p IS NOT NULL OR q IS NOT NULL
      GROUP BY 1"""


def _drift(spark: SparkSession, sf: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    baseline, current = baseline_and_current(event_log(spark, sf))
    return monitor.drift(baseline, current, "inference_ts", numeric, categorical)


_PSI_TEXT = _psi_sql(_TEXT_BIN, "event_type", False)
_PSI_NUMBER = _psi_sql(_BIN, "amount", True)


@query(
    "q_psi_categorical",
    f'{_E} SELECT window_start, "column", metric, round(value, 6) AS value FROM ({_PSI_TEXT})',
)
def psi_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return _days(_drift(spark, sf, [], ["event_type"]), "value")


@query(
    "q_psi_numeric",
    f'{_E} SELECT window_start, "column", metric, round(value, 6) AS value FROM ({_PSI_NUMBER})',
)
def psi_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _days(_drift(spark, sf, ["amount"], []), "value")


@query(
    "q_drift_alerts",
    f"""{_E} SELECT window_start, "column", metric, round(value, 6) AS value, 2e-1 AS threshold
    FROM ({_PSI_TEXT} UNION ALL {_PSI_NUMBER}) WHERE value > 2e-1""",
)
def drift_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _days(monitor.drift_alerts(_drift(spark, sf, ["amount"], ["event_type"])), "value")


def _shares_sql(bins: str, column: str, edges: bool) -> str:
    source = f", (SELECT {_EDGES} FROM base)" if edges else ""
    side = f"""SELECT {bins} AS bin, count(*) / (SELECT count(*)::DOUBLE FROM {{0}}) AS share
      FROM {{0}}{source} GROUP BY 1"""
    return f"""
      SELECT '{column}' AS "column", nullif(bin, '(null)') AS bin, coalesce(x.share, 0e0) AS baseline_share,
        coalesce(y.share, 0e0) AS current_share
      FROM ({side.format("base")}) x FULL JOIN ({side.format("cur")}) y USING (bin)"""


_SHARES = f"{_shares_sql(_BIN, 'amount', True)} UNION ALL {_shares_sql(_TEXT_BIN, 'event_type', False)}"


def _compared(spark: SparkSession, sf: str) -> DataFrame:
    baseline, current = baseline_and_current(event_log(spark, sf))
    edges = monitor.fit_bins(baseline, ["amount"])
    sides = [monitor.bin_shares(monitor.binned(side, edges, ["event_type"])) for side in (baseline, current)]
    return monitor.compare_shares(*sides)


@query(
    "q_bin_shares",
    f"""{_E} SELECT "column", bin, round(baseline_share, 6) AS baseline_share,
    round(current_share, 6) AS current_share FROM ({_SHARES})""",
)
def bin_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(spark, sf).withColumns(
        {c: F.round(c, 6) for c in ("baseline_share", "current_share")}
    )


@query(
    "q_psi_overall",
    f"""{_E} SELECT "column", round(sum({_TERM.format(p="baseline_share", q="current_share")}), 6) AS psi
    FROM ({_SHARES}) GROUP BY 1""",
)
def psi_overall(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.psi(_compared(spark, sf)).withColumn("psi", F.round("psi", 6))


_JUDGED = """SELECT day, CASE actual WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS label,
  CASE prediction WHEN 'Yes' THEN 1e0 ELSE 0e0 END AS prob FROM """
_RATIOS = ", ".join(f'round("{m}", 6) AS "{m}"' for m in METRICS)


def _label():
    return F.when(F.col("actual").isNotNull(), (F.col("actual") == "Yes").cast("int"))


def _said():
    return (F.col("prediction") == "Yes").cast("int")


@query(
    "q_quality_daily",
    f"""{_E} SELECT day AS window_start, tp, fp, fn, tn, {_RATIOS}
    FROM ({confusion_sql(f"({_JUDGED} cur)", "prob", "day")})""",
)
def quality_daily(spark: SparkSession, sf: str) -> DataFrame:
    _, current = baseline_and_current(event_log(spark, sf))
    return _days(monitor.quality_by_window(current, "inference_ts", _label(), _said()), *METRICS)


@query(
    "q_quality_alerts",
    f"""{_E}, b AS (SELECT f1 AS base FROM ({confusion_sql(f"({_JUDGED} base)", "prob")})),
     q AS (SELECT day, f1 FROM ({confusion_sql(f"({_JUDGED} cur)", "prob", "day")}))
    SELECT day AS window_start, 'actual' AS "column", 'f1_relative_drop' AS metric,
      round((base - f1) / base, 6) AS value, 5e-2 AS threshold
    FROM q, b WHERE base > 0 AND (base - f1) / base > 5e-2""",
)
def quality_alerts(spark: SparkSession, sf: str) -> DataFrame:
    baseline, current = baseline_and_current(event_log(spark, sf))
    by_window = monitor.quality_by_window(current, "inference_ts", _label(), _said())
    base_f1 = confusion_metrics(baseline, _label(), _said()).select("f1").scalar()
    return _days(monitor.quality_alerts(by_window, base_f1, "actual"), "value")


@query(
    "q_monitor_refresh",
    f"""{_E}, b AS (SELECT f1 AS base FROM ({confusion_sql(f"({_JUDGED} base)", "prob")})),
     q AS (SELECT day, f1 FROM ({confusion_sql(f"({_JUDGED} cur)", "prob", "day")}))
    SELECT window_start, "column", metric, round(value, 6) AS value, threshold,
      CAST(1 AS BIGINT) AS n_ok, CAST(2 AS BIGINT) AS n_tables
    FROM (
      SELECT window_start, "column", metric, value, 2e-1 AS threshold
      FROM ({_PSI_TEXT} UNION ALL {_PSI_NUMBER}) WHERE value > 2e-1
      UNION ALL SELECT day, 'actual', 'f1_relative_drop', (base - f1) / base, 5e-2
      FROM q, b WHERE base > 0 AND (base - f1) / base > 5e-2)""",
)
def monitor_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Monitors of every log of one name: one log is whole, the other has no time column and fails.

    Gives the alerts stored for the whole log, beside how many logs were found and refreshed.
    """
    baseline, current = baseline_and_current(event_log(spark, sf))
    good, bad = scratch_database(spark), scratch_database(spark)
    log_name = f"log_{good}"
    scored_log.append(current, f"{good}.{log_name}", many_days=True)
    current.drop("inference_ts").write.format("parquet").saveAsTable(f"{bad}.{log_name}")

    def refresh(name: str) -> None:
        write_monitors(monitor_log(spark.table(name), baseline, EVENTS), name, EVENTS.target)

    results = refresh_summary(refresh_all(spark, log_name, refresh)).first()
    return _days(spark.table(f"{good}.{log_name}_alerts"), "value").withColumns(
        {c: F.lit(results[c]).cast("bigint") for c in ("n_ok", "n_tables")}
    )


_SPANS = {"1 day": "day", "7 days": "strftime(DATE '1970-01-01' + CAST(7 * (date_diff('day', DATE '1970-01-01', inference_ts::DATE) // 7) AS INTEGER), '%Y-%m-%d')"}


def _windows_sql(granularity: str, start: str) -> str:
    """Profile, drift and quality rows of all windows of the log, from the log as a whole."""
    numbers = [
        f"SELECT day AS window_start, 'amount' AS \"column\", '{m}' AS metric, CAST({sql} AS DOUBLE) AS value FROM spans GROUP BY day"
        for m, sql in _NUMBER_METRICS.items()
    ]
    texts = [
        f"SELECT day, '{c}', '{m}', CAST({sql.format(c=c)} AS DOUBLE) FROM spans GROUP BY day"
        for c in ("event_type", "prediction")
        for m, sql in _TEXT_METRICS.items()
    ]
    drift = [sql.replace("FROM cur", "FROM spans").replace("FROM e", "FROM both_sides") for sql in (_PSI_TEXT, _PSI_NUMBER)]
    ratios = [
        f"SELECT day, 'actual', '{m}', \"{m}\" FROM ({confusion_sql(f'({_JUDGED} spans)', 'prob', 'day')})" for m in METRICS
    ]
    parts = " UNION ALL ".join([*numbers, *texts, *drift, *ratios])
    return f"""SELECT '{granularity}' AS granularity, window_start, "column", metric, round(value, 6) AS value FROM (
      WITH spans AS (SELECT * EXCLUDE (day), {start} AS day FROM cur),
        both_sides AS (SELECT * FROM base UNION ALL SELECT * FROM spans)
      {parts})"""


@query("q_refresh_incremental", f"{_E} " + " UNION ALL ".join(_windows_sql(g, start) for g, start in _SPANS.items()))
def refresh_by_days(spark: SparkSession, sf: str) -> DataFrame:
    """Metric tables of a log that came in three appends, each followed by a refresh, in windows of a day and of a week.

    The second append begins where the first ends, and the third holds late rows of all days.
    """
    baseline, current = baseline_and_current(event_log(spark, sf))
    late, second = F.col("event_id") % 5 == 0, F.col("inference_ts") >= F.to_timestamp_ntz(F.lit("2024-01-25"))
    found = []
    names = {granularity: f"{scratch_database(spark)}.log" for granularity in _SPANS}
    for part in (current.where(~late & ~second), current.where(~late & second), current.where(late)):
        for granularity, name in names.items():
            scored_log.append(part, name, many_days=True)
            refresh_incremental(spark, name, baseline, EVENTS.with_(granularity=granularity))
    for granularity, name in names.items():
        for suffix in ("profile_metrics", "drift_metrics", "quality_metrics"):
            found.append(_days(spark.table(f"{name}_{suffix}"), "value").select(F.lit(granularity).alias("granularity"), "*"))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


_RANKED = """SELECT day, event_type, label, rank() OVER (PARTITION BY day, event_type ORDER BY amount)
    + (count(*) OVER (PARTITION BY day, event_type, amount) - 1) / 2e0 AS r
  FROM (SELECT day, event_type, amount, (actual = 'Yes')::INTEGER AS label FROM e WHERE actual IS NOT NULL AND amount IS NOT NULL)"""


@query(
    "q_auc_by_window",
    f"""{_E} SELECT day AS window_start, event_type, positives, negatives, round(CASE WHEN positives > 0 AND negatives > 0
      THEN (ranks - positives * (positives + 1) / 2e0) / (positives * negatives) END, 6) AS roc_auc
    FROM (SELECT day, event_type, count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives,
            sum(r) FILTER (WHERE label = 1) AS ranks FROM ({_RANKED}) GROUP BY day, event_type)""",
)
def auc_by_window(spark: SparkSession, sf: str) -> DataFrame:
    """How well amounts tell the label, for every day and kind of event, all groups in one pass."""
    judged = monitor.with_window(event_log(spark, sf), "inference_ts").withColumn("label", _label())
    return _days(auc_by(judged, "label", "amount", (monitor.WINDOW, "event_type")), "roc_auc")
