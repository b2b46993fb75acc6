"""Small append-only tables of JSON files that any number of writers add to at once.

Appending Parquet to one table from two jobs at a time makes their commits share a work folder, and one may delete the
other's. Here every addition is a file of its own that appears whole under its final name or not at all, and a name is
given once: so a name can also be claimed.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """The rows published so far, by any session; none if there is no such table yet."""
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], schema)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def folder(spark: SparkSession, name: str, schema: str) -> str:
    """Where the files of the table lie; the table is created if needed."""
    if not spark.catalog.tableExists(name):
        try:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING json")
        except Exception:
            # another writer may have been first
            if not spark.catalog.tableExists(name):
                raise
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if facts["Provider"].lower() != "json":
        raise ValueError(f"{name} is a table of {facts['Provider']} files, not of records")
    return facts["Location"].rstrip("/")


def _file_system(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names(spark: SparkSession, place: str, start: str) -> list[str]:
    """Names of the published files that begin with `start`."""
    files, path = _file_system(spark, f"{place}/{start}*.json")
    return [status.getPath().getName() for status in files.globStatus(path) or []]


def _line(row: tuple, fields: list[str]) -> str:
    plain = (v.astimezone().isoformat() if isinstance(v, datetime) else v for v in row)
    # numbers of numpy become plain ones
    return json.dumps(dict(zip(fields, plain, strict=True)), default=lambda v: v.item())


def publish(spark: SparkSession, name: str, schema: str, rows: list[tuple], claim: str | None = None, place: str | None = None) -> bool:
    """Add the rows in one file, called `claim` or by a fresh name. False, and nothing added, if the claim is taken.

    The file appears whole: it is written beside and then linked (local folders) or renamed, which file systems with
    atomic renames refuse if the target is there.
    """
    place = place or folder(spark, name, schema)
    fields = T.StructType.fromDDL(schema).fieldNames()
    data = "".join(_line(row, fields) + "\n" for row in rows).encode("utf-8")
    target, work = f"{place}/{claim or uuid.uuid4().hex}.json", f"{place}/.{uuid.uuid4().hex}.tmp"
    files, path = _file_system(spark, work)
    if files.getUri().getScheme() == "file":
        final = _file_system(spark, target)[1].toUri().getPath()
        local = path.toUri().getPath()
        with open(local, "wb") as out:
            out.write(data)
        try:
            os.link(local, final)
            added = True
        except FileExistsError:
            added = False
        finally:
            os.unlink(local)
    else:
        out = files.create(path, True)
        out.write(bytearray(data))
        out.close()
        added = files.rename(path, _file_system(spark, target)[1])
        if not added:
            files.delete(path, False)
    spark.catalog.refreshTable(name)
    return added
