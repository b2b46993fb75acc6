"""Keyed feature tables whose upserts rewrite only the buckets that a batch touches.

Rows lie in buckets by a hash of the key. A version of the table is a manifest: the folder of each bucket, in a table
`<name>__buckets` with versions of its own. An upsert reads and writes the buckets of the batch's keys and makes a
manifest that shares all other folders with the one before, so the bytes written follow the batch and not the table.
Readers hold the folders of one manifest; a merge that breaks off leaves folders that no manifest names, and `vacuum`
removes those. One writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage
from tidemark.sources.feature_table import KeyViolation, _split_name, _versions, replace_table, require_unique_key, retire, upsert_rows

_MANIFEST = "bucket int, folder string, n_rows long, buckets int, key string, columns string"
_BUCKET = "_bucket"


def _manifest_name(spark: SparkSession, name: str) -> str:
    place, table = _split_name(spark, name)
    return f"{place}.`{table}__buckets`"


def _root(spark: SparkSession, name: str) -> str:
    place, table = _split_name(spark, name)
    location = spark.sql(f"DESCRIBE DATABASE {place}").where("info_name = 'Location'").first().info_value
    return f"{location.rstrip('/')}/{table}__bucket_files"


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(_manifest_name(spark, name))


def _bucket_of(key: str, buckets: int):
    return F.pmod(F.hash(F.col(key)), F.lit(buckets)).cast("int")


def _write(df: DataFrame, name: str, key: str, buckets: int, tasks: int) -> list[tuple[int, str, int]]:
    """Write rows by bucket; gives the bucket, folder and row count of each."""
    spark = df.sparkSession
    folder = f"{_root(spark, name)}/{uuid.uuid4().hex}"
    dealt = df.withColumn(_BUCKET, _bucket_of(key, buckets)).repartition(max(1, tasks), _BUCKET)
    dealt.sortWithinPartitions(_BUCKET, key).write.partitionBy(_BUCKET).parquet(folder)
    # at most a row per bucket; an empty table has no folder
    counts = spark.read.schema(T.StructType([T.StructField(_BUCKET, T.IntegerType())])).option("basePath", folder).parquet(folder).groupBy(_BUCKET).count()
    return [(r[_BUCKET], f"{folder}/{_BUCKET}={r[_BUCKET]}", r["count"]) for r in counts.collect()]


def _publish(spark: SparkSession, name: str, entries: list[tuple[int, str, int]], buckets: int, key: str, schema: T.StructType) -> int:
    rows = [(b, f, n, buckets, key, schema.json()) for b, f, n in sorted(entries)] or [(None, None, 0, buckets, key, schema.json())]
    replace_table(spark.createDataFrame(rows, _MANIFEST).coalesce(1), _manifest_name(spark, name))
    return sum(n for _, _, n in entries)


def create(df: DataFrame, name: str, key: str, buckets: int) -> int:
    """First version; an error if the table is there already or its key is null or repeated. Gives the row count."""
    spark = df.sparkSession
    if exists(spark, name):
        raise ValueError(f"Feature table {name} already exists")
    entries = _write(df, name, key, buckets, buckets)
    # where it lies: the rows are not worked out again; what is refused stays without a manifest
    require_unique_key(_read(spark, [f for _, f, _ in entries], df.schema), key)
    return _publish(spark, name, entries, buckets, key, df.schema)


def _manifest(spark: SparkSession, name: str) -> list:
    """One row per bucket that holds rows, all of the newest version."""
    return spark.table(_manifest_name(spark, name)).collect()


def _read(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows of some buckets; columns that their files lack are null."""
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def open_table(spark: SparkSession, name: str) -> DataFrame:
    """The newest version."""
    held = _manifest(spark, name)
    schema = T.StructType.fromJson(json.loads(held[0]["columns"]))
    return _read(spark, [r.folder for r in held if r.folder], schema)


def merge(df: DataFrame, name: str) -> int:
    """Upsert: rows of `df` take the place of those with the same key. Gives the row count of the table.

    Columns that `df` lacks keep their values, columns that the table lacks are added. A null or repeated key in `df` is
    an error, and a column of another type than the table's too.
    """
    spark = df.sparkSession
    held = _manifest(spark, name)
    buckets, key = held[0].buckets, held[0].key
    schema = T.StructType.fromJson(json.loads(held[0]["columns"]))
    kinds = {f.name: f.dataType for f in schema}
    changed = [f.name for f in df.schema if f.name in kinds and f.dataType != kinds[f.name]]
    if changed:
        raise ValueError(f"{', '.join(changed)}: other types than in {name}")
    df = cut_lineage(df)
    require_unique_key(df, key)
    touched = {r[0] for r in df.select(_bucket_of(key, buckets)).distinct().collect()}
    entries = {r.bucket: (r.bucket, r.folder, r.n_rows) for r in held if r.folder}
    if touched:
        old = _read(spark, [entries[b][1] for b in sorted(touched) if b in entries], schema)
        rows = upsert_rows(old, df, key)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        entries |= {e[0]: e for e in _write(rows, name, key, buckets, len(touched))}
    return _publish(spark, name, list(entries.values()), buckets, key, schema)


def write(df: DataFrame, name: str, key: str, buckets: int) -> int:
    """Create on the first run, upsert afterwards."""
    if not exists(df.sparkSession, name):
        return create(df, name, key, buckets)
    held = _manifest(df.sparkSession, name)[0]
    if (held.key, held.buckets) != (key, buckets):
        raise KeyViolation(f"{name} has {held.buckets} buckets of {held.key}")
    return merge(df, name)


def vacuum(spark: SparkSession, name: str, keep: int = 1, grace: float = 24 * 3600.0) -> list[str]:
    """Drop old manifests as `feature_table.retire` does, and the folders that no manifest left names.

    Folders younger than `grace` seconds stay, since a merge may be about to name them. Gives the folders removed.
    """
    manifest = _manifest_name(spark, name)
    retire(spark, manifest, keep, grace)
    place, table = _split_name(spark, manifest)
    named: set[str] = set()
    for version in _versions(spark, manifest):
        named |= {r.folder for r in spark.table(f"{place}.`{table}__v{version}`").select("folder").collect() if r.folder}
    used = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in named}
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark, name))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = []
    for found in files.listStatus(path) if files.exists(path) else []:
        folder = found.getPath()
        if folder.getName() not in used and time.time() - found.getModificationTime() / 1000 > grace:
            files.delete(folder, True)
            removed.append(folder.getName())
            continue
        # of a folder in use, buckets that newer merges have replaced
        for part in files.listStatus(folder) if folder.getName() in used else []:
            held = part.getPath()
            old = time.time() - part.getModificationTime() / 1000 > grace
            if held.getName().startswith(f"{_BUCKET}=") and old and not any(n.endswith(f"/{folder.getName()}/{held.getName()}") for n in named):
                files.delete(held, True)
                removed.append(f"{folder.getName()}/{held.getName()}")
    return removed
