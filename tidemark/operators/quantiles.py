"""Exact quantiles of groups of any size, by one path.

Copies of a value are merged first. The distinct values are then dealt to ranges in order of group and value, each range
is summed up per group, and the sums before a range place its values among all of the group's. So no task holds more
than a range, whatever the size of a group, and nothing is estimated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def in_ranges(values: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows dealt to ranges in order of group and value; `_range` numbers the ranges as they lie, and stays so as stored."""
    return cut_lineage(values.repartitionByRange(*by, value).withColumn("_range", F.spark_partition_id()))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], copies: str | None = None) -> DataFrame:
    """Linear-interpolated quantiles of the non-null values per group, as array `quantiles`.

    `by` names at least one group column; a null key is a group like others. A group without values has no row. `copies`
    names a column that says how often a row's value stands in the group; without it each row counts once.
    """
    by = list(by)
    values = (
        df.select(*by, F.col(value).cast("double").alias("v"), (F.col(copies) if copies else F.lit(1)).cast("long").alias("c"))
        .where("v is not null")
        .groupBy(*by, "v")
        .agg(F.sum("c").alias("copies"))
    )
    placed = in_ranges(values, by, "v")
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # at most a row per group and range
    sums = (
        placed.groupBy(*by, "_range")
        .agg(F.sum("copies").alias("in_range"))
        .withColumn("before", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
        .withColumn("n", F.sum("in_range").over(Window.partitionBy(*by)))
        .drop("in_range")
        .withColumnsRenamed({c: f"_{c}" for c in [*by, "_range"]})
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "_range"]]
    upto = Window.partitionBy(*by, "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    reached = placed.join(sums, same).withColumn("reached", F.col("before") + F.sum("copies").over(upto))

    def ranked(i: int, edge: str) -> str:
        return f"_{edge}{i}"

    found = []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        for edge, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            found.append(F.min(F.when(F.col("reached") > rank, F.col("v"))).alias(ranked(i, edge)))
    edges = reached.groupBy(*by).agg(F.max("n").alias("_n"), *found)

    def between(i: int, p: float):
        low, high = F.col(ranked(i, "lo")), F.col(ranked(i, "hi"))
        place = (F.col("_n") - 1) * F.lit(float(p))
        share = place - F.floor(place)
        return F.when(low == high, low).otherwise((1 - share) * low + share * high)

    return edges.select(*by, F.array(*[between(i, p) for i, p in enumerate(probs)]).alias("quantiles"))


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column; None for a column without any value."""
    found = column_quantiles(df, columns, [0.5])
    return {c: (found[c][0] if c in found else None) for c in columns}


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles of each column, brought to the driver: one short row per column."""
    if not columns:
        return {}
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    tall = df.select(F.inline(F.array(*pairs)))
    return {row["column"]: list(row["quantiles"]) for row in exact_quantiles(tall, ["column"], "value", probs).collect()}
