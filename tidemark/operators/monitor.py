"""Watch a scored log: daily profiles, drift against a baseline, model quality, alerts.

All results are long tables `(window_start, column, metric, value)`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import nan_to_null
from tidemark.operators.metrics import METRICS, auc_by, confusion_metrics
from tidemark.operators.quantiles import column_quantiles, exact_quantiles

WINDOW = "window_start"
SHARE_FLOOR = 1e-4
DECILES = tuple(i / 10 for i in range(1, 10))
_QUARTILES = (0.25, 0.5, 0.75)
_ID = [WINDOW, "column"]


def with_window(df: DataFrame, ts: str, granularity: str = "1 day") -> DataFrame:
    """Start of the window of each row; rows without a time have a null window of their own."""
    some_time = F.coalesce(F.col(ts).cast("timestamp"), F.lit("1970-01-01").cast("timestamp"))
    started = df.withColumn(WINDOW, F.window(some_time, granularity)["start"])
    return started.withColumn(WINDOW, F.when(F.col(ts).isNotNull(), F.col(WINDOW)))


def _join_windows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on window and column; a null window meets the null window."""
    other = right.withColumnsRenamed({c: f"_{c}" for c in _ID})
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _ID], "left").drop(*[f"_{c}" for c in _ID])


def _tall(df: DataFrame, values: dict[str, Column], keep: Sequence[str], name: str = "value") -> DataFrame:
    """One row per record and column."""
    pairs = [F.struct(F.lit(c).alias("column"), v.alias(name)) for c, v in values.items()]
    return df.select(*keep, F.inline(F.array(*pairs)))


def _long(wide: DataFrame, metrics: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return wide.select(*_ID, F.inline(F.array(*pairs)))


def profile(
    df: DataFrame,
    ts: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    granularity: str = "1 day",
) -> DataFrame:
    """Counts, nulls, distinct values and, for numbers, moments, extremes and quartiles per window and column."""
    windowed = with_window(df, ts, granularity)
    parts = []
    if numeric:
        tall = _tall(windowed, {c: nan_to_null(F.col(c).cast("double")) for c in numeric}, [WINDOW])
        base = tall.groupBy(*_ID).agg(
            *_counts(),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        quartiles = exact_quantiles(tall, _ID, "value", _QUARTILES)
        joined = _join_windows(base, quartiles).withColumns(
            {f"p{int(p * 100)}": F.col("quantiles")[i] for i, p in enumerate(_QUARTILES)}
        )
        names = ("count", "nulls", "null_rate", "distinct", "mean", "std", "min", "p25", "p50", "p75", "max")
        parts.append(_long(joined, names))
    if categorical:
        tall = _tall(windowed, {c: F.col(c).cast("string") for c in categorical}, [WINDOW])
        parts.append(_long(tall.groupBy(*_ID).agg(*_counts()), ("count", "nulls", "null_rate", "distinct")))
    if not parts:
        raise ValueError("Name at least one column to profile")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _counts() -> list[Column]:
    return [
        F.count("*").alias("count"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.avg(F.when(F.col("value").isNull(), 1.0).otherwise(0.0)).alias("null_rate"),
        F.count_distinct("value").alias("distinct"),
    ]


def fit_bins(baseline: DataFrame, numeric: Sequence[str]) -> dict[str, list[float]]:
    """Inner decile edges of each number column; equal edges are merged. At most nine numbers per column."""
    values = baseline.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in numeric])
    found = column_quantiles(values, numeric, DECILES)
    return {c: sorted(set(found.get(c, []))) for c in numeric}


def bin_number(column: Column, edges: Sequence[float]) -> Column:
    """Number of edges below the value, as text; both end bins are open; null has a bin of its own."""
    value = nan_to_null(column.cast("double"))
    place = F.lit(0)
    for edge in edges:
        place = place + F.when(value > edge, 1).otherwise(0)
    return F.when(value.isNotNull(), place.cast("string"))


def binned(
    df: DataFrame, edges: dict[str, list[float]], categorical: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per record and column with the record's bin; a null bin holds the missing values."""
    bins = {c: bin_number(F.col(c), e) for c, e in edges.items()}
    bins |= {c: F.col(c).cast("string") for c in categorical}
    return _tall(df, bins, keep, "bin")


def bin_shares(tall: DataFrame, by: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """Share of every bin within its column (and window); `copies` says how many records a row stands for."""
    ids = [*by, "column"]
    counts = tall.groupBy(*ids, "bin").agg((F.sum(copies) if copies else F.count("*")).alias("n"))
    totals = counts.groupBy(*ids).agg(F.sum("n").alias("total")).withColumnsRenamed({c: f"_{c}" for c in ids})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ids]
    return counts.join(totals, same).select(*ids, "bin", (F.col("n") / F.col("total")).alias("share"))


def compare_shares(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Baseline and current share of every bin that occurs on either side; zero where it is absent."""
    base = baseline.select("column", "bin", F.col("share").alias("baseline_share"), F.lit(True).alias("_b"))
    cur = current.select(
        F.col("column").alias("_column"), F.col("bin").alias("_bin"), F.col("share").alias("current_share")
    )
    same = (F.col("column") == F.col("_column")) & F.col("bin").eqNullSafe(F.col("_bin"))
    return base.join(cur, same, "full_outer").select(
        F.coalesce("column", "_column").alias("column"),
        F.when(F.col("_b"), F.col("bin")).otherwise(F.col("_bin")).alias("bin"),
        F.coalesce("baseline_share", F.lit(0.0)).alias("baseline_share"),
        F.coalesce("current_share", F.lit(0.0)).alias("current_share"),
    )


def _term(p: Column, q: Column) -> Column:
    p, q = F.greatest(p, F.lit(SHARE_FLOOR)), F.greatest(q, F.lit(SHARE_FLOOR))
    return (q - p) * F.ln(q / p)


def psi(shares: DataFrame) -> DataFrame:
    """Population stability index per column from compared shares."""
    return shares.groupBy("column").agg(F.sum(_term(F.col("baseline_share"), F.col("current_share"))).alias("psi"))


def drift(
    baseline: DataFrame,
    current: DataFrame,
    ts: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    granularity: str = "1 day",
) -> DataFrame:
    """Population stability index of every column in every window of `current` against `baseline`."""
    edges = fit_bins(baseline, numeric)
    base = bin_shares(binned(baseline, edges, categorical))
    return drift_of_shares(base, bin_shares(binned(with_window(current, ts, granularity), edges, categorical, [WINDOW]), [WINDOW]))


def drift_of_shares(base: DataFrame, cur: DataFrame) -> DataFrame:
    """Population stability index per window and column from the shares of the baseline and of each window."""
    # A baseline bin that a window lacks counts with the floor share. Their sum over all baseline bins is a
    # constant per column, and the bins that do occur take their part out again: no window has to be paired
    # with every baseline bin.
    floor = F.lit(SHARE_FLOOR)
    absent = base.groupBy("column").agg(F.sum(_term(F.col("share"), floor)).alias("all_absent"))
    base_side = base.select(
        F.col("column").alias("_column"), F.col("bin").alias("_bin"), F.col("share").alias("baseline_share")
    )
    same = (F.col("column") == F.col("_column")) & F.col("bin").eqNullSafe(F.col("_bin"))
    matched = cur.join(base_side, same, "left")
    p = F.col("baseline_share")
    gained = _term(F.coalesce(p, F.lit(0.0)), F.col("share")) - F.when(p.isNotNull(), _term(p, floor)).otherwise(0.0)
    per_window = matched.groupBy(*_ID).agg(F.sum(gained).alias("present"))
    total = F.col("present") + F.coalesce("all_absent", F.lit(0.0))
    return per_window.join(absent, "column", "left").select(
        *_ID, F.lit("psi").alias("metric"), total.alias("value")
    )


def drift_alerts(drifted: DataFrame, threshold: float = 0.20) -> DataFrame:
    """Windows and columns whose index is above the threshold."""
    return drifted.where(F.col("value") > threshold).withColumn("threshold", F.lit(float(threshold)))


def quality_by_window(
    df: DataFrame, ts: str, label: Column, predicted: Column, granularity: str = "1 day"
) -> DataFrame:
    """Confusion counts and ratios per window over the rows that carry a label."""
    return confusion_metrics(with_window(df, ts, granularity), label, predicted, (WINDOW,))


def auc_by_window(df: DataFrame, ts: str, label: Column, probability: str, target: str, granularity: str = "1 day") -> DataFrame:
    """Exact area under the ROC curve per window as a long table; null where a window has one class only."""
    judged = with_window(df, ts, granularity).select(WINDOW, label.alias("_label"), F.col(probability).alias("_prob"))
    return auc_metrics(auc_by(judged, "_label", "_prob", (WINDOW,)), target)


def auc_metrics(by_window: DataFrame, target: str) -> DataFrame:
    return _long(by_window.withColumn("column", F.lit(target)), ("roc_auc",))


def quality_metrics(by_window: DataFrame, target: str) -> DataFrame:
    """The same as a long table."""
    return _long(by_window.withColumn("column", F.lit(target)), METRICS)


def quality_alerts(by_window: DataFrame, baseline_f1: Column | float, target: str, threshold: float = 0.05) -> DataFrame:
    """Windows whose F1 fell by more than `threshold` relative to the baseline; none if that is zero."""
    base = baseline_f1 if isinstance(baseline_f1, Column) else F.lit(float(baseline_f1))
    drop = (F.col("base") - F.col("f1")) / F.col("base")
    return (
        by_window.withColumn("base", base)
        .where((F.col("base") > 0) & (drop > threshold))
        .select(
            WINDOW,
            F.lit(target).alias("column"),
            F.lit("f1_relative_drop").alias("metric"),
            drop.alias("value"),
            F.lit(float(threshold)).alias("threshold"),
        )
    )

