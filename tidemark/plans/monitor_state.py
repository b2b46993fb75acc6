"""Refresh the monitors of a log by what has been appended to it.

Beside a log `<log>`, partitioned by day, lie

- `<log>_window_state`: counts of values per day, window and column (`operators/window_counts.py`), partitioned by day;
- `<log>_window_files`: which files of each day, which settings and which baseline the metrics rest on;
- `<log>_baseline_<fingerprint>`: bins, shares and F1 of a baseline, so that it is read once.

A refresh reads the days whose files have changed, replaces their counts, and derives the figures of the windows that
these days touch from the counts of all their days. A day counts as changed until the metrics are in place, so a
refresh that breaks off is made good by the next one. Two refreshes of one log must not run at the same time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.numeric import is_positive
from tidemark.operators import monitor, window_counts
from tidemark.operators.metrics import auc_by, confusion_metrics, with_ratios
from tidemark.session import cut_lineage
from tidemark.sources.feature_table import replace_table, retire
from tidemark.sources.scored_log import DATE_COLUMN

#: Seconds for which readers of a superseded version of a metric table are left alone.
KEEP_SECONDS = 24 * 3600.0
#: Day of the rows without a time.
NO_DAY = "none"
#: Stands in a count table for the outcome of a prediction; no column has an empty name.
OUTCOME = ""
_OUTCOMES = ("tp", "fp", "fn", "tn")
#: Column of the log with the probability of the positive class, and names under which a count table has its values for
#: rows of either label.
PROBABILITY = "prediction_prob"
_SCORES = {" positive": 1, " negative": 0}
_LEDGER = "day string, files string, settings string, baseline string"


@dataclass(frozen=True)
class Baseline:
    """What drift and quality are held against: inner bin edges, shares of bins, and F1 if there are predictions."""

    fingerprint: str
    edges: dict[str, list[float]]
    shares: DataFrame
    f1: float | None


def is_partitioned(spark: SparkSession, log_name: str) -> bool:
    """Whether a log is partitioned by day."""
    return any(c.isPartition and c.name == DATE_COLUMN for c in spark.catalog.listColumns(log_name))


def window_bounds(spark: SparkSession, first: date, last: date, granularity: str) -> tuple[datetime, datetime]:
    """Start of the window that holds the first moment of `first`, and end of the one that holds the last of `last`."""
    opening = F.lit(first).cast("timestamp")
    closing = F.date_add(F.lit(last), 1).cast("timestamp") - F.expr("interval 1 microsecond")
    rows = spark.range(1).select(F.explode(F.array(opening, closing)).alias("t"))
    found = rows.select(F.window("t", granularity).alias("w")).agg(F.min("w.start"), F.max("w.end")).first()
    return found[0], found[1]


def _digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()[:32]


def _columns(df: DataFrame, config: Config) -> tuple[list[str], list[str]]:
    return [c for c in config.numeric if c in df.columns], [c for c in config.categorical if c in df.columns]


def _outcome(config: Config) -> Column:
    """tp, fp, fn or tn; null without a label."""
    label, said = F.col(config.target), is_positive(F.col("prediction"), config.positive)
    yes = is_positive(label, config.positive)
    named = F.when(yes & said, "tp").when(~yes & said, "fp").when(yes, "fn").otherwise("tn")
    return F.when(label.isNotNull(), named)


def kept_baseline(spark: SparkSession, baseline: DataFrame, config: Config, base: str, like: DataFrame) -> Baseline:
    """The baseline as it bears on the columns of `like`, from its table if the same baseline has been seen before.

    A baseline is known by the files it reads and its query. One that reads no files is worked out each time.
    """
    numeric, categorical = _columns(like, config)
    files = sorted(baseline.inputFiles())
    judged = config.target in like.columns and {"prediction", config.target} <= set(baseline.columns)
    fingerprint = _digest(files, baseline.semanticHash(), baseline.schema.json(), numeric, categorical, judged, config.target, config.positive)
    name = f"{base}_baseline_{fingerprint[:16]}"
    if not files or not spark.catalog.tableExists(name):
        edges = monitor.fit_bins(baseline, numeric)
        shares = monitor.bin_shares(monitor.binned(baseline, edges, categorical))
        rows = [("edge", c, None, e) for c, inner in edges.items() for e in inner]
        if judged:
            said = is_positive(F.col("prediction"), config.positive).cast("int")
            label = F.when(F.col(config.target).isNotNull(), is_positive(F.col(config.target), config.positive).cast("int"))
            rows.append(("f1", None, None, confusion_metrics(baseline, label, said).select("f1").first()[0]))
        figures = spark.createDataFrame(rows, "kind string, `column` string, bin string, value double")
        figures = figures.unionByName(shares.select(F.lit("share").alias("kind"), "column", "bin", F.col("share").alias("value")))
        if not files:
            return _baseline(cut_lineage(figures), fingerprint, numeric)
        # a folder of the same name that a broken refresh has left is overwritten
        figures.write.mode("overwrite").format("parquet").saveAsTable(name)
    return _baseline(spark.table(name), fingerprint, numeric)


def _baseline(figures: DataFrame, fingerprint: str, numeric: list[str]) -> Baseline:
    edges: dict[str, list[float]] = {c: [] for c in numeric}
    f1 = None
    # nine numbers per column at most
    for row in figures.where("kind <> 'share'").collect():
        if row.kind == "f1":
            f1 = row.value
        else:
            edges[row["column"]].append(row.value)
    shares = figures.where("kind = 'share'").select("column", "bin", F.col("value").alias("share"))
    return Baseline(fingerprint, {c: sorted(e) for c, e in edges.items()}, shares, f1)


def _files_by_day(log: DataFrame) -> dict[str, str]:
    """Digest of the names of each day's files; files of a log are added, never changed."""
    names = defaultdict(list)
    for path in log.inputFiles():
        found = re.search(rf"/{DATE_COLUMN}=([^/]*)/", path)
        day = unquote(found.group(1)) if found else NO_DAY
        names[NO_DAY if day == "__HIVE_DEFAULT_PARTITION__" else day].append(path.rsplit("/", 1)[1])
    return {day: _digest(sorted(held)) for day, held in names.items()}


def _day_text() -> Column:
    return F.coalesce(F.col(DATE_COLUMN).cast("string"), F.lit(NO_DAY)).alias("day")


def _on_days(days: set[str]) -> Column:
    """Rows of the log of some days, as a filter on its partitions."""
    dated = sorted(date.fromisoformat(d) for d in days - {NO_DAY})
    chosen = F.col(DATE_COLUMN).isin(dated) if dated else F.lit(False)
    return chosen | F.col(DATE_COLUMN).isNull() if NO_DAY in days else chosen


def _counts(rows: DataFrame, config: Config, ts: str) -> DataFrame:
    """Count table of some rows of a log per day."""
    numeric, categorical = _columns(rows, config)
    outputs = ["prediction"] if "prediction" in rows.columns else []
    if outputs and config.target in rows.columns:
        rows = rows.withColumn(OUTCOME, _outcome(config))
        outputs.append(OUTCOME)
    scores = []
    if len(outputs) > 1 and PROBABILITY in rows.columns:
        label, prob = F.col(config.target), F.col(PROBABILITY).cast("double")
        for name, wanted in _SCORES.items():
            yes = is_positive(label, config.positive) if wanted else ~is_positive(label, config.positive)
            rows = rows.withColumn(name, F.when(label.isNotNull() & yes, prob))
        scores = list(_SCORES)
    dated = rows.withColumn("_day", _day_text())
    counted = window_counts.value_counts(dated, ts, [*numeric, *scores], [*categorical, *outputs], config.granularity, ["_day"])
    return counted.select(monitor.WINDOW, "column", "number", "text", "n", F.col("_day").alias("day"))


def _touched(spark: SparkSession, days: set[str], granularity: str) -> tuple[DataFrame, set[str]]:
    """Starts of all windows that some days touch, and the days that these windows touch."""
    dated = [(date.fromisoformat(d),) for d in sorted(days - {NO_DAY})]
    ends = spark.createDataFrame(dated, "day date").select(
        F.window(F.col("day").cast("timestamp"), granularity)["start"].alias("first"),
        F.window(F.date_add("day", 1).cast("timestamp") - F.expr("interval 1 microsecond"), granularity)["start"].alias("last"),
    )
    starts = ends.select(F.explode(F.expr(f"sequence(first, last, interval {granularity})")).alias(monitor.WINDOW)).distinct()
    end = F.col(monitor.WINDOW) + F.expr(f"interval {granularity}") - F.expr("interval 1 microsecond")
    beside = starts.select(F.explode(F.sequence(F.to_date(monitor.WINDOW), F.to_date(end))).alias("day")).distinct()
    wanted = {str(r.day) for r in beside.collect()}
    if NO_DAY in days:
        starts = starts.union(spark.createDataFrame([(None,)], "w timestamp"))
        wanted.add(NO_DAY)
    return starts, wanted


def _write_counts(spark: SparkSession, counts: DataFrame | None, name: str, gone: set[str]) -> None:
    """Put the counts of some days in the place of those the table has, and drop the days that the log lost."""
    if counts is not None and not spark.catalog.tableExists(name):
        counts.write.format("parquet").partitionBy("day").saveAsTable(name)
        return
    if counts is not None:
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            counts.write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(mode, before)
    for day in sorted(gone):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (day = '{day}')")


def _metrics(counts: DataFrame, baseline: Baseline, config: Config) -> dict[str, DataFrame]:
    """The metric tables of the windows in `counts` (added, and stored)."""
    scored = F.col("column").isin(*_SCORES)
    plain, outcomes = counts.where((F.col("column") != OUTCOME) & ~scored), counts.where(F.col("column") == OUTCOME)
    numeric = list(baseline.edges)
    categorical = [c for c in config.categorical if c not in numeric]
    drifted = cut_lineage(monitor.drift_of_shares(baseline.shares, window_counts.window_shares(plain, baseline.edges, categorical)))
    alerts = monitor.drift_alerts(drifted, config.psi_threshold)
    sums = [F.coalesce(F.sum(F.when(F.col("text") == o, F.col("n"))), F.lit(0)).alias(o) for o in _OUTCOMES]
    judged = outcomes.where("text IS NOT NULL").groupBy(monitor.WINDOW).agg(*sums)
    quality = cut_lineage(with_ratios(judged, (monitor.WINDOW,)))
    if baseline.f1 is not None:
        alerts = alerts.unionByName(monitor.quality_alerts(quality, baseline.f1, config.target, config.f1_drop_threshold))
    labelled = counts.where(scored & F.col("number").isNotNull()).withColumn("label", (F.col("column") == " positive").cast("int"))
    areas = monitor.auc_metrics(auc_by(labelled, "label", "number", (monitor.WINDOW,), "n"), config.target)
    return {
        "profile_metrics": window_counts.profile(plain, numeric),
        "drift_metrics": drifted,
        "alerts": alerts,
        "quality_metrics": monitor.quality_metrics(quality, config.target).unionByName(areas),
    }


def refresh_incremental(
    spark: SparkSession, log_name: str, baseline: DataFrame, config: Config, ts: str = "inference_ts", grace: float = KEEP_SECONDS
) -> list[str]:
    """Bring the metric tables of a log up to date; gives the days that were read.

    The result is that of a refresh of the whole log: late rows change the windows of their day, days that the log lost
    go, and other columns, settings or another baseline are worked in. After a change of columns or settings the whole log
    is read, after one of the baseline no day of it. Windows have a fixed length ("1 hour", "1 day", "7 days").
    """
    base = log_name.replace("`", "")
    spark.catalog.refreshTable(log_name)
    log = spark.table(log_name)
    numeric, categorical = _columns(log, config)
    settings = _digest(numeric, categorical, config.granularity, config.target, config.positive, *[c in log.columns for c in ("prediction", PROBABILITY, config.target)])
    figures = kept_baseline(spark, baseline, config, base, log)
    rest = _digest(figures.fingerprint, config.psi_threshold, config.f1_drop_threshold)

    files = _files_by_day(log)
    ledger, state = f"{base}_window_files", f"{base}_window_state"
    known = {r.day: r for r in spark.table(ledger).collect()} if spark.catalog.tableExists(ledger) else {}
    whole = any(r.settings != settings for r in known.values())
    changed = {d for d, f in files.items() if whole or d not in known or known[d].files != f}
    gone = set(known) - set(files)
    everywhere = not known or whole or any(r.baseline != rest for r in known.values())
    if not changed and not gone and not everywhere:
        return []

    if whole:
        spark.sql(f"DROP TABLE IF EXISTS {state}")
    if changed or gone or not spark.catalog.tableExists(state):
        rows = log if changed == set(files) else log.where(_on_days(changed))
        # no day to read leaves the counts as they are; the first refresh makes the table even for an empty log
        fresh_days = changed or not spark.catalog.tableExists(state)
        _write_counts(spark, _counts(rows, config, ts) if fresh_days else None, state, gone)
    counts, starts = spark.table(state), None
    if not everywhere:
        starts, days = _touched(spark, changed | gone, config.granularity)
        starts = cut_lineage(starts)
        same = F.col(monitor.WINDOW).eqNullSafe(F.col("_touched"))
        counts = counts.where(F.col("day").isin(sorted(days))).join(starts.withColumnRenamed(monitor.WINDOW, "_touched"), same, "left_semi")
    fresh = _metrics(cut_lineage(window_counts.added(counts)), figures, config)
    for suffix, df in fresh.items():
        name = f"{base}_{suffix}"
        if not everywhere and spark.catalog.tableExists(name):
            same = F.col(monitor.WINDOW).eqNullSafe(F.col("_touched"))
            others = spark.table(name).join(starts.withColumnRenamed(monitor.WINDOW, "_touched"), same, "left_anti")
            df = others.unionByName(df)
        replace_table(df, name)
        retire(spark, name, grace=grace)
    replace_table(spark.createDataFrame([(d, f, settings, rest) for d, f in sorted(files.items())], _LEDGER), ledger)
    retire(spark, ledger)
    return sorted(changed)
