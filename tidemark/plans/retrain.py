"""Retraining as one driver function: check, store features, train, gate, promote."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.operators import quality
from tidemark.operators.features import LABEL, combine, combine_newest, exclude_keys, prepare, project_features, project_labels
from tidemark.operators.gate import GateResult, evaluate_gate, require_passed
from tidemark.operators.models import TrainResult, score, train_all
from tidemark.operators.split import mark_share
from tidemark.sources import feature_table, run_log
from tidemark.sources.registry import CHAMPION, AliasNotFound, Registry, load_model


@dataclass
class RetrainResult:
    batch_id: str
    runs: list[TrainResult]
    gate: GateResult
    champion_version: int
    serving_version: int


def draw_holdout(df: DataFrame, config: Config, share: float = 0.15) -> DataFrame:
    """A stratified share of the table, in a random order apart from the train/test split's."""
    hit = F.col(config.target).eqNullSafe(F.lit(config.positive)).cast("int")
    return mark_share(df, config.key, share, f"holdout{config.seed}", hit, "_held").where("_held").drop("_held")


def training_rows(
    labels: DataFrame, features: DataFrame, config: Config, holdout: DataFrame | None = None
) -> DataFrame:
    """Every label row with its features, without the rows that the gate will judge by."""
    rows = feature_table.lookup(labels, features, config.key)
    return exclude_keys(rows, holdout, config.key) if holdout is not None else rows


def gate_candidate(
    holdout: DataFrame, config: Config, registry: Registry, challenger_path: str, threshold: float | None = None
) -> GateResult:
    """Score the holdout with the challenger and, if there is one, the champion, and compare.

    Only a missing alias counts as a first deployment; any other failure is raised.
    """
    rows = prepare(holdout, config, keep_key=True).select(config.key, *config.features, LABEL)
    scored = score(rows, load_model(challenger_path)).drop("predicted").withColumnRenamed("prob", "challenger_prob")
    champion_prob = None
    try:
        champion, _ = registry.load(config.model_name, CHAMPION)
    except AliasNotFound:
        pass
    else:
        scored = score(scored, champion).drop("predicted").withColumnRenamed("prob", "champion_prob")
        champion_prob = "champion_prob"
    scored = scored.select(LABEL, "challenger_prob", *([champion_prob] if champion_prob else []))
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        limit = config.gate_threshold if threshold is None else threshold
        return evaluate_gate(scored, LABEL, "challenger_prob", champion_prob, limit)
    finally:
        scored.unpersist()


def retrain(
    spark: SparkSession,
    source: DataFrame,
    config: Config,
    prefix: str,
    model_root: str,
    holdout: DataFrame,
    new_rows: DataFrame | None = None,
    exclude_holdout: bool = True,
    buckets: int | None = None,
    search: bool = False,
) -> RetrainResult:
    """Run the whole path; a failed check or gate raises and nothing after it happens.

    Tables are named after `prefix`: `<prefix>_features` for features, `<prefix>_runs` and so on for the log,
    `<prefix>_versions` and `<prefix>_aliases` for the registry. `search` has the grids searched before training.
    """
    data = combine(source, new_rows) if new_rows is not None else source
    quality.require_passed(quality.check_input(data, config))
    # one row per key before both projections: a new row brings its features and its label
    data = combine_newest(source, new_rows if new_rows is not None else source.limit(0), config.key)

    table = f"{prefix}_features"
    feature_table.write(project_features(data, config), table, config.key, buckets)

    labels = project_labels(data, config)
    rows = training_rows(labels, spark.table(table), config, holdout if exclude_holdout else None)
    batch = uuid.uuid4().hex
    runs = train_all(rows, config, batch, prefix, model_root, search)

    run_id, _, _ = run_log.require_best_run(spark, prefix, f"test_{config.primary_metric}")
    best_path = spark.table(f"{prefix}_runs").where(F.col("run_id") == run_id).first().model_path
    registry = Registry(spark, prefix)
    verdict = gate_candidate(holdout, config, registry, best_path)
    require_passed(verdict)
    champion, serving = registry.promote(config.model_name, run_id)
    return RetrainResult(batch, runs, verdict, champion, serving)
