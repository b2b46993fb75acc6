"""Append-only log of scored rows, partitioned by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_COLUMN = "inference_date"


def _fitting(name: str, given: T.DataType, kept: T.DataType) -> Column:
    """The batch's column as the log keeps it; a value that the log's type cannot hold fails the batch."""
    value = F.col(name)
    if given == kept:
        return value.alias(name)
    changed = value.try_cast(kept)
    back = changed.try_cast(given)
    text = F.concat(F.lit(f"{name}: the log keeps {kept.simpleString()} and cannot hold "), value.cast("string"))
    return F.when(value.isNull() | back.eqNullSafe(value), changed).otherwise(F.raise_error(text).cast(kept)).alias(name)


def append(scored: DataFrame, name: str, ts: str = "inference_ts", many_days: bool = False) -> None:
    """Append to the log; columns the log lacks are added to it, columns the batch lacks are null.

    Names are compared as the catalog does, without case. A value that the log's type cannot hold is an error.

    The schema grows in the catalog, so readers need no footer merge over all files. `many_days` is for
    batches that span days: rows are gathered by day first, so that not every task writes a file for every
    day, and a day with very many rows is still spread over several tasks.
    """
    spark = scored.sparkSession
    rows = scored.withColumn(DATE_COLUMN, F.to_date(ts))
    if many_days:
        rows = rows.hint("rebalance", DATE_COLUMN)
    if not spark.catalog.tableExists(name):
        rows.write.format("parquet").partitionBy(DATE_COLUMN).saveAsTable(name)
        return
    stored = spark.table(name).schema
    known = {f.name.lower() for f in stored}
    added = [f for f in rows.schema if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        stored = spark.table(name).schema
    present = {f.name.lower(): f.dataType for f in rows.schema}
    aligned = rows.select(
        *[
            _fitting(f.name, present[f.name.lower()], f.dataType) if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in stored
        ]
    )
    aligned.write.insertInto(name)
