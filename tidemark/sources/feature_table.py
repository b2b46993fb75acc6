"""Keyed feature tables: create, upsert and look up.

Each write makes a new table `<name>__v<N>`; the view `<name>` is the pointer that readers use, so a
reader sees one whole version. With `buckets` the versions are bucketed by the key, and then neither the
upsert nor a lookup shuffles the stored side.
"""

from __future__ import annotations

import math
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Property of a version that tells when another one took its place, in seconds since 1970.
SUPERSEDED = "tidemark.superseded"


#: Bytes that the feature rows of frequent keys may have to be sent to all tasks.
MOST_HOT_BYTES = 32 << 20


class KeyViolation(ValueError):
    """The key of a feature table is null or repeated."""


def key_problems(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, rows without a key, and keys that occur more than once."""
    counts = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
    )


def require_unique_key(df: DataFrame, key: str) -> int:
    """Row count, or KeyViolation if the key is null or repeated anywhere."""
    found = key_problems(df, key).first()
    if found.null_keys or found.repeated_keys:
        raise KeyViolation(f"{key}: {found.null_keys} rows without key, {found.repeated_keys} repeated keys")
    return found.n_rows


def _split_name(spark: SparkSession, name: str) -> tuple[str, str]:
    """Quoted place of a table, catalog included where one is named, and its own name."""
    parts = name.replace("`", "").split(".")
    if len(parts) > 3:
        raise ValueError(f"{name} has more than a catalog, a database and a table")
    place = parts[:-1] or [spark.catalog.currentDatabase()]
    return ".".join(f"`{p}`" for p in place), parts[-1]


def _versions(spark: SparkSession, name: str) -> list[int]:
    place, table = _split_name(spark, name)
    pattern = re.compile(re.escape(table.lower()) + r"__v(\d+)$")
    listed = spark.sql(f"SHOW TABLES IN {place} LIKE '{table}__v*'").collect()
    matches = (pattern.match(t.tableName.lower()) for t in listed)
    return sorted(int(m.group(1)) for m in matches if m)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _bucket_count(spark: SparkSession, name: str) -> int | None:
    """Buckets of the newest version, None if it has none."""
    place, table = _split_name(spark, name)
    newest = f"{place}.`{table}__v{_versions(spark, name)[-1]}`"
    described = spark.sql(f"DESCRIBE EXTENDED {newest}").where("col_name = 'Num Buckets'").first()
    return int(described.data_type) if described else None


def _publish(df: DataFrame, name: str, key: str, buckets: int | None, in_buckets: bool = False) -> int:
    """Write a version, check its key where it lies, then move the pointer. Returns the row count.

    `in_buckets` says that the tasks of `df` hold one bucket each already.
    """
    spark = df.sparkSession
    place, table = _split_name(spark, name)
    version = max(_versions(spark, name), default=0) + 1
    target = f"{place}.`{table}__v{version}`"
    if buckets:
        # hash partitioning and bucketing agree, so each task writes one bucket file
        rows = df if in_buckets else df.repartition(buckets, key)
        rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(target)
    else:
        df.write.format("parquet").saveAsTable(target)
    try:
        rows = require_unique_key(spark.table(target), key)
    except KeyViolation:
        spark.sql(f"DROP TABLE {target}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {place}.`{table}` AS SELECT * FROM {target}")
    return rows


def replace_table(df: DataFrame, name: str) -> None:
    """Write a version of a table without key, then move the pointer to it."""
    spark = df.sparkSession
    place, table = _split_name(spark, name)
    target = f"{place}.`{table}__v{max(_versions(spark, name), default=0) + 1}`"
    df.write.format("parquet").saveAsTable(target)
    spark.sql(f"CREATE OR REPLACE VIEW {place}.`{table}` AS SELECT * FROM {target}")


def create(df: DataFrame, name: str, key: str, buckets: int | None = None) -> int:
    """First version of a feature table; an error if the table is there already."""
    if exists(df.sparkSession, name):
        raise ValueError(f"Feature table {name} already exists")
    return _publish(df, name, key, buckets)


def upsert_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of `new` in place of rows with the same key, the other rows of `old` kept.

    Columns that `new` lacks keep their stored values; a key that is new has nulls there.

    One full outer join: where `old` is bucketed by the key its rows stay where they are, and every task
    goes on holding one bucket.
    """
    incoming = new.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in new.columns], F.lit(True).alias("_hit")
    )
    joined = old.join(incoming, F.col(key) == F.col("_key"), "full_outer")

    def pick(c: str):
        kept = F.col(c) if c in old.columns else F.lit(None)
        value = F.col(f"_new_{c}") if c in new.columns else kept
        return F.when(F.col("_hit"), value).otherwise(kept).alias(c)

    return joined.select(*[pick(c) for c in [*old.columns, *[c for c in new.columns if c not in old.columns]]])


def merge(df: DataFrame, name: str, key: str, buckets: int | None = None) -> int:
    """Upsert into an existing feature table."""
    spark = df.sparkSession
    in_buckets = buckets is not None and _bucket_count(spark, name) == buckets
    return _publish(upsert_rows(spark.table(name), df, key), name, key, buckets, in_buckets)


def write(df: DataFrame, name: str, key: str, buckets: int | None = None) -> int:
    """Create on the first run, upsert afterwards."""
    return (merge if exists(df.sparkSession, name) else create)(df, name, key, buckets)


def retire(spark: SparkSession, name: str, keep: int = 1, grace: float = 0.0) -> list[int]:
    """Drop all but the newest `keep` versions; the newest is the one that readers see. Returns what was dropped.

    A frame that was opened before a version was superseded still reads that version. With `grace`, a version goes only
    when it has been superseded for so many seconds, which has to be longer than readers work; the time counts from the
    first call that finds it superseded.
    """
    place, table = _split_name(spark, name)
    now, dropped = time.time(), []
    for version in _versions(spark, name)[: -max(1, keep)]:
        target = f"{place}.`{table}__v{version}`"
        if grace:
            held = spark.sql(f"SHOW TBLPROPERTIES {target}").where(F.col("key") == SUPERSEDED).first()
            if held is None:
                spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{SUPERSEDED}' = '{now}')")
            if held is None or now - float(held.value) < grace:
                continue
        spark.sql(f"DROP TABLE {target}")
        dropped.append(version)
    return dropped


def lookup(rows: DataFrame, features: DataFrame, key: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Every row of `rows` with the features of its key; nulls where the key has none.

    The feature key is unique, so no row is multiplied. A key repeated often in `rows` makes one large
    shuffle partition on the left of a left join, which adaptive execution splits.
    """
    return rows.join(features, key, "left").drop(*exclude)


def frequent_keys(rows: DataFrame, key: str, share: float) -> list:
    """Keys that hold about `share` of the rows or more, at most 1 / `share` of them, from summaries merged over tasks.

    Summaries hold a bounded number of keys and their counts are estimates: a key near the limit may be in or out.
    """
    most = math.ceil(1 / share)
    summary = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(min(16 * most, 1_000_000)))
    found = rows.where(F.col(key).isNotNull()).agg(summary.alias("top"), F.count("*").alias("n")).first()
    return [t["item"] for t in found.top if t["count"] >= share * found.n]


def lookup_spread(rows: DataFrame, features: DataFrame, key: str, exclude: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """As `lookup`, for rows of which a few keys may hold most, and for features bucketed by the key too.

    Adaptive execution does not cut the buckets of a stored side. So rows of frequent keys, a quarter of a task's share or
    more each with `tasks` tasks (shuffle partitions by default), stay where they are and get copies of the few feature
    rows of those keys; the others go to the buckets. Rows without a key stay as well. Feature rows too wide for copies
    are joined by a shuffle, which adaptive execution cuts. `rows` is read twice and has to be the same both times. Which
    keys count as frequent changes where rows go, never the result.
    """
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = frequent_keys(rows, key, 1 / (4 * tasks))
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    copies = features.where(is_hot)
    size = copies.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first().n if hot else 0
    if (size or 0) <= MOST_HOT_BYTES:
        copies = F.broadcast(copies)
    stays = F.col(key).isNull() | is_hot
    spread = lookup(rows.where(stays), copies, key)
    return spread.unionByName(lookup(rows.where(~stays), features, key)).drop(*exclude)
