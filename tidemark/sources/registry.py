"""Model versions and aliases as append-only tables of records, and saved pipelines."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources import records, run_log

VERSIONS = "name string, version int, run_id string, created_at timestamp"
ALIASES = "name string, alias string, version int, set_at timestamp"
CHAMPION, SERVING = "champion", "serving"


class AliasNotFound(LookupError):
    """No version carries the alias."""


def save_model(model: PipelineModel, path: str) -> str:
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _newest_first(aliases: DataFrame) -> Window:
    return Window.partitionBy("name", "alias").orderBy(F.desc("set_at"), F.desc("version"))


def latest_aliases(aliases: DataFrame) -> DataFrame:
    """The version each alias points to now. The rank filter is applied before the shuffle as well."""
    return (
        aliases.withColumn("_n", F.row_number().over(_newest_first(aliases)))
        .where("_n = 1")
        .drop("_n")
    )


def resolve_aliases(aliases: DataFrame, versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Alias to version to run, for every alias."""
    return (
        latest_aliases(aliases)
        .join(versions.select("name", "version", "run_id"), ["name", "version"])
        .join(runs, "run_id")
        .select("name", "alias", "version", "run_id", *[c for c in runs.columns if c != "run_id"])
    )


def rollback_targets(aliases: DataFrame) -> DataFrame:
    """For every alias the current version, and the last one that came into use before it first did; else null.

    A version that was withdrawn came later than the one it was withdrawn for, so going back again passes it by.
    """
    times = aliases.groupBy("name", "alias", "version").agg(F.min("set_at").alias("begun"), F.max("set_at").alias("set_at"))
    whole = Window.partitionBy("name", "alias")
    current = F.max(F.struct("set_at", "version", "begun")).over(whole)
    placed = times.withColumn("_current", current)
    earlier = F.when(F.struct("begun", "version") < F.struct("_current.begun", "_current.version"), F.struct("begun", "version"))
    return placed.groupBy("name", "alias").agg(
        F.max("_current.version").alias("current_version"), F.max(earlier)["version"].alias("previous_version")
    )


class Registry:
    """Registry tables `<prefix>_versions` and `<prefix>_aliases` beside a run log of the same prefix."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.prefix = spark, prefix

    def _table(self, kind: str) -> DataFrame:
        return records.read(self.spark, f"{self.prefix}_{kind}", VERSIONS if kind == "versions" else ALIASES)

    def register(self, name: str, run_id: str) -> int:
        """A new version of the model, one above the highest.

        The number is claimed by the name of the record's file, which only one writer can give; a writer that comes
        second takes the next number. So any number of jobs may register at once, and numbers have no gaps.
        """
        table, model = f"{self.prefix}_versions", hashlib.sha256(name.encode("utf-8")).hexdigest()[:32]
        place = records.folder(self.spark, table, VERSIONS)
        while True:
            taken = records.names(self.spark, place, f"{model}-")
            version = max((int(n.removesuffix(".json").rpartition("-")[2]) for n in taken), default=0) + 1
            row = (name, version, run_id, datetime.now(timezone.utc))
            if records.publish(self.spark, table, VERSIONS, [row], f"{model}-{version}", place):
                return version

    def set_alias(self, name: str, alias: str, version: int) -> None:
        records.publish(self.spark, f"{self.prefix}_aliases", ALIASES, [(name, alias, version, datetime.now(timezone.utc))])

    def version_of(self, name: str, alias: str) -> int:
        row = latest_aliases(
            self._table("aliases").where((F.col("name") == name) & (F.col("alias") == alias))
        ).first()
        if row is None:
            raise AliasNotFound(f"{name} has no alias {alias}")
        return row.version

    def model_path(self, name: str, version: int) -> str:
        """Where the pipeline of a version is stored."""
        found = (
            self._table("versions")
            .where((F.col("name") == name) & (F.col("version") == version))
            .join(records.read(self.spark, f"{self.prefix}_runs", run_log.RUNS), "run_id")
            .select("model_path")
            .first()
        )
        if found is None:
            raise LookupError(f"{name} has no version {version} with a logged run")
        return found.model_path

    def load(self, name: str, alias: str | None = None, version: int | None = None) -> tuple[PipelineModel, int]:
        """The pipeline behind an alias or a version number, with the version."""
        version = version if version is not None else self.version_of(name, alias or CHAMPION)
        return load_model(self.model_path(name, version)), version

    def promote(self, name: str, run_id: str) -> tuple[int, int]:
        """Register the run twice and move both aliases, the champion's and the serving one."""
        champion = self.register(name, run_id)
        self.set_alias(name, CHAMPION, champion)
        serving = self.register(name, run_id)
        self.set_alias(name, SERVING, serving)
        return champion, serving

    def roll_back(self, name: str, alias: str = CHAMPION) -> int:
        """Point the alias at the version in use before the current one first was; LookupError if there was none."""
        rows = self._table("aliases").where((F.col("name") == name) & (F.col("alias") == alias))
        row = rollback_targets(rows).first()
        if row is None or row.previous_version is None:
            raise LookupError(f"{name}@{alias} has no earlier version")
        self.set_alias(name, alias, row.previous_version)
        return row.previous_version
