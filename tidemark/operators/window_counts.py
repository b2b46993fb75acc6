"""Monitor figures from counts of values, which add up over parts of a log.

A count table has a row per window, column and value: `window_start`, `column`, `number` or `text`, and `n`. Counts of two
parts of a log, added, are the counts of both, and all figures of a window follow from them exactly: profile, drift and,
by the counts of prediction and label, quality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import nan_to_null
from tidemark.operators import monitor
from tidemark.operators.monitor import WINDOW
from tidemark.operators.quantiles import exact_quantiles

_ID = [WINDOW, "column"]
_VALUE = ["number", "text"]


def value_counts(df: DataFrame, ts: str, numeric: Sequence[str], categorical: Sequence[str], granularity: str, keep: Sequence[str] = ()) -> DataFrame:
    """Counts of the values of every column per window (and per value of the columns in `keep`)."""
    none_number, none_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    # -0.0 and 0.0 are one value
    pairs = [F.struct(F.lit(c).alias("column"), (nan_to_null(F.col(c).cast("double")) + 0.0).alias("number"), none_text.alias("text")) for c in numeric]
    pairs += [F.struct(F.lit(c).alias("column"), none_number.alias("number"), F.col(c).cast("string").alias("text")) for c in categorical]
    tall = monitor.with_window(df, ts, granularity).select(*keep, WINDOW, F.inline(F.array(*pairs)))
    return tall.groupBy(*keep, *_ID, *_VALUE).agg(F.count("*").alias("n"))


def added(counts: DataFrame) -> DataFrame:
    """Counts of several parts as those of the whole."""
    return counts.groupBy(*_ID, *_VALUE).agg(F.sum("n").alias("n"))


def profile(counts: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """What `monitor.profile` gives, from added counts of the same rows."""
    of_number = F.col("column").isin(*numeric)
    number, n = F.col("number"), F.col("n")
    missing = number.isNull() & F.col("text").isNull()
    known = F.when(number.isNotNull(), n)
    base = counts.groupBy(*_ID).agg(
        F.sum("n").alias("count"),
        F.coalesce(F.sum(F.when(missing, n)), F.lit(0)).alias("nulls"),
        F.count_if(~missing).alias("distinct"),
        (F.sum(number * n) / F.sum(known)).alias("mean"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
    ).withColumn("null_rate", F.col("nulls") / F.col("count"))
    texts = monitor._long(base.where(~of_number), ("count", "nulls", "null_rate", "distinct"))
    if not numeric:
        return texts
    numbers = counts.where(of_number)
    # deviations from the mean, as squares of the values themselves would lose digits
    means = base.select(*[F.col(c).alias(f"_{c}") for c in _ID], "mean")
    spread = numbers.join(means, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _ID])
    off = number - F.col("mean")
    std = spread.groupBy(*_ID).agg(F.sqrt(F.sum(off * off * n) / F.sum(known)).alias("std"))
    quartiles = exact_quantiles(numbers, _ID, "number", monitor._QUARTILES, copies="n")
    joined = monitor._join_windows(monitor._join_windows(base.where(of_number), std), quartiles).withColumns(
        {f"p{int(p * 100)}": F.col("quantiles")[i] for i, p in enumerate(monitor._QUARTILES)}
    )
    names = ("count", "nulls", "null_rate", "distinct", "mean", "std", "min", "p25", "p50", "p75", "max")
    return monitor._long(joined, names).unionByName(texts)


def window_shares(counts: DataFrame, edges: dict[str, list[float]], categorical: Sequence[str]) -> DataFrame:
    """Share of every bin per window and column, as `monitor.bin_shares` has it for the rows themselves."""
    chosen: Column = F.when(F.col("column").isin(*categorical), F.col("text")) if categorical else F.lit(None).cast("string")
    for column, inner in edges.items():
        chosen = F.when(F.col("column") == column, monitor.bin_number(F.col("number"), inner)).otherwise(chosen)
    wanted = counts.where(F.col("column").isin(*edges, *categorical))
    return monitor.bin_shares(wanted.withColumn("bin", chosen).select(*_ID, "bin", "n"), [WINDOW], "n")
