"""Named scans, loads from text files, databases and table discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import to_number
from tidemark.functions.text import identifier


def read_table(spark: SparkSession, default: str, override: str | None = None) -> DataFrame:
    """A catalog table, or a parquet folder when the name holds a slash; `override` wins if given."""
    name = override or default
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def load_csv(spark: SparkSession, path: str, schema: T.StructType, blank_to_null: list[str] = ()) -> DataFrame:
    """CSV with a header and a fixed schema; the named columns are read as text and coerced.

    Blank text in a coerced column becomes null instead of an error or a dropped row.
    """
    raw = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in blank_to_null else f.dataType) for f in schema]
    )
    # the header has to name the columns in this order; by position they could be swapped unseen
    df = spark.read.schema(raw).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*[(_coerced(df, f) if f.name in blank_to_null else F.col(f.name)).alias(f.name) for f in schema])


def _coerced(df: DataFrame, field: T.StructField) -> Column:
    """Text as the field's own type; blanks and what does not fit are null, so long whole numbers keep every digit."""
    if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
        return to_number(df, field.name).cast(field.dataType)
    return F.trim(field.name).try_cast(field.dataType)


def load_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, name: str, blank_to_null: list[str] = (), mode: str = "overwrite"
) -> DataFrame:
    """Load a CSV with header into the catalog table `name` and return the table."""
    load_csv(spark, path, schema, blank_to_null).write.mode(mode).format("parquet").saveAsTable(name)
    return spark.table(name)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if needed, below `location` if one is given."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if needed and make it current."""
    create_database(spark, name, location)
    spark.catalog.setCurrentDatabase(name)


def user_database(spark: SparkSession) -> str:
    """Database name derived from the current user."""
    return spark.range(1).select(identifier(F.current_user())).first()[0]


def catalog_names(spark: SparkSession) -> list[str]:
    """Catalogs that the session has loaded, and those that its settings name."""
    prefix = "spark.sql.catalog."
    named = {k.removeprefix(prefix) for k in spark.conf.getAll if k.startswith(prefix)}
    return sorted({c.name for c in spark.catalog.listCatalogs()} | {n for n in named if "." not in n})


def find_tables(spark: SparkSession, name: str) -> tuple[list[str], list[tuple[str, str]]]:
    """Qualified names of tables called `name` in any database of any catalog, and places that could not be listed.

    Names are led by their catalog unless it is the current one. One unreadable place hides no other.
    """
    found, failed = [], []
    current = spark.catalog.currentCatalog()
    for catalog in catalog_names(spark):
        lead = "" if catalog == current else f"`{catalog}`."
        try:
            databases = [r[0] for r in spark.sql(f"SHOW DATABASES IN `{catalog}`").collect()]
        except Exception as error:
            failed.append((catalog, str(error)))
            continue
        for database in databases:
            try:
                listed = spark.sql(f"SHOW TABLES IN `{catalog}`.`{database}` LIKE '{name}'").collect()
            except Exception as error:
                failed.append((f"{lead}{database}" if lead else database, str(error)))
                continue
            found += [f"{lead}`{database}`.`{name}`" for r in listed if r.tableName == name and not getattr(r, "isTemporary", False)]
    return sorted(found), failed
