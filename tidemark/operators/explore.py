"""Look at a table: shape, counts, rates, means, nulls, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import is_positive, rate


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def sample_rows(df: DataFrame, order: str, n: int = 10) -> DataFrame:
    """The first n rows in key order: a top-n, not a sort of the table."""
    return df.orderBy(order).limit(n)


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(*keys)


def positive_rate(df: DataFrame, target: str, positive: object, *segments: str) -> DataFrame:
    """Rows, positives and their share, overall or per segment, in one pass."""
    hit = is_positive(F.col(target), positive)
    return df.groupBy(*segments).agg(
        F.count("*").alias("n_rows"),
        F.count_if(hit).alias("n_positive"),
        rate(hit).alias("positive_rate"),
    )


def top_segment(rates: DataFrame, segment: str) -> DataFrame:
    """The segment with the highest rate, the first by name among equals."""
    return rates.orderBy(F.desc("positive_rate"), segment).limit(1)


def rate_ratio(rates: DataFrame, segment: str, base: object) -> DataFrame:
    """Each segment's rate as a multiple of the base segment's."""
    base_rate = rates.where(F.col(segment) == base).agg(F.max("positive_rate")).scalar()
    return rates.withColumn("ratio_to_base", F.try_divide("positive_rate", base_rate))


def group_means(df: DataFrame, group: str, digits: dict[str, int]) -> DataFrame:
    """Rounded mean of every named column per group, and the row count."""
    means = [F.round(F.mean(c), d).alias(f"avg_{c}") for c, d in digits.items()]
    return df.groupBy(group).agg(*means, F.count("*").alias("count")).orderBy(group)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in df.columns]
    return counts.select(F.inline(F.array(*pairs)))


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).where("null_count > 0")


def segment(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet every condition."""
    for condition in conditions:
        df = df.where(condition)
    return df


def histogram(df: DataFrame, column: str, width: float, low: float = 0.0) -> DataFrame:
    """Rows per bin of equal width, bins counted from `low`."""
    number = F.floor((F.col(column) - low) / width).cast("bigint")
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.count("*").alias("count"))
        .select("bin", (F.col("bin") * width + low).alias("bin_start"), "count")
        .orderBy("bin")
    )
