"""Apply a fitted pipeline to tables: whole, by key, split between two models, or as a what-if."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.numeric import hash_percent
from tidemark.operators.explore import positive_rate
from tidemark.operators.features import FEATURES, prepare
from tidemark.operators.models import score
from tidemark.sources.feature_table import lookup

STABLE, CANARY = "stable", "canary"
_WORKING = [FEATURES, "predicted", "prob"]


def predict(df: DataFrame, model: PipelineModel, config: Config) -> DataFrame:
    """`df` with `predicted` 0/1 and `prob`; its own columns keep their values and types."""
    clash = [c for c in _WORKING if c in df.columns]
    if clash:
        raise ValueError(f"Column names used by scoring: {clash}")
    changed = [c for c in config.as_string if c in df.columns]
    hidden = df.withColumns({f"_raw_{c}": F.col(c) for c in changed}) if changed else df
    labelled = config.target in df.columns
    if labelled:
        hidden = hidden.withColumnRenamed(config.target, "_raw_target")
    scored = score(prepare(hidden, config, keep_key=True), model)
    out = []
    for c in df.columns:
        if c in changed:
            out.append(F.col(f"_raw_{c}").alias(c))
        elif c == config.target:
            out.append(F.col("_raw_target").alias(c))
        else:
            out.append(F.col(c))
    return scored.select(*out, "predicted", "prob")


def score_differences(rows: DataFrame, first: PipelineModel, second: PipelineModel) -> DataFrame:
    """Prepared rows, and how many of them two pipelines score differently: `n_rows`, `n_different`.

    Each row is computed once and meets both models. Computed again it may differ in its last bits, as sums of doubles
    follow the order in which shuffled parts arrive, and a key that repeats would meet itself in a join.
    """
    one = score(rows, first).drop("predicted").withColumnRenamed("prob", "_first")
    same = F.col("_first").eqNullSafe(F.col("prob"))
    return score(one, second).agg(F.count("*").alias("n_rows"), F.count_if(~same).alias("n_different"))


def decode(
    scored: DataFrame, config: Config, model_id: Column | str, inference_ts: datetime | Column | None = None
) -> DataFrame:
    """Class text, probability, model tag and time in the shape of the scored log."""
    if inference_ts is None:
        stamp = F.current_timestamp()
    else:
        stamp = inference_ts if isinstance(inference_ts, Column) else F.lit(inference_ts)
    tag = model_id if isinstance(model_id, Column) else F.lit(model_id)
    kept = [c for c in scored.columns if c not in ("predicted", "prob")]
    return scored.select(
        *kept,
        F.when(F.col("predicted") == 1, F.lit(config.positive)).otherwise(F.lit(config.negative)).alias("prediction"),
        F.col("prob").alias("prediction_prob"),
        tag.alias("model_id"),
        stamp.alias("inference_ts"),
    )


def score_table(
    df: DataFrame, model: PipelineModel, config: Config, model_id: str, inference_ts: datetime | Column | None = None
) -> DataFrame:
    """Score a whole table in one plan; nothing leaves the executors."""
    return decode(predict(df, model, config), config, model_id, inference_ts)


def score_keys(
    keys: DataFrame,
    features: DataFrame,
    model: PipelineModel,
    config: Config,
    model_id: str,
    inference_ts: datetime | Column | None = None,
) -> DataFrame:
    """Score rows given by key only, with the features looked up."""
    return score_table(lookup(keys, features, config.key), model, config, model_id, inference_ts)


def canary_shares(stable_version: int | None, new_version: int, percent: int = 10) -> dict[int, int]:
    """Percent of the rows per version: no change for the same version, all for a first one."""
    if stable_version is None or stable_version == new_version:
        return {new_version: 100}
    return {stable_version: 100 - percent, new_version: percent}


def canary_route(df: DataFrame, key: str, percent: int = 10) -> DataFrame:
    """`route` per row, fixed by the key: the same key always meets the same model."""
    route = F.when(hash_percent(F.col(key)) < percent, F.lit(CANARY)).otherwise(F.lit(STABLE))
    return df.withColumn("route", route)


def canary_score(
    df: DataFrame,
    models: dict[int, PipelineModel],
    stable_version: int | None,
    new_version: int,
    config: Config,
    name: str,
    percent: int = 10,
    inference_ts: datetime | Column | None = None,
) -> DataFrame:
    """Score each slice of the table with its own model and put the slices together."""
    shares = canary_shares(stable_version, new_version, percent)
    if len(shares) == 1:
        return score_table(df, models[new_version], config, f"{name}_v{new_version}", inference_ts)
    routed = canary_route(df, config.key, percent)
    slices = [
        score_table(
            routed.where(F.col("route") == route).drop("route"),
            models[version],
            config,
            f"{name}_v{version}",
            inference_ts,
        )
        for route, version in ((STABLE, stable_version), (CANARY, new_version))
    ]
    return slices[0].unionByName(slices[1])


def what_if(
    df: DataFrame,
    model: PipelineModel,
    config: Config,
    segment: Column,
    changes: dict[str, Column],
    by: str,
) -> DataFrame:
    """Predicted rate per group as things are, and with some columns changed for a segment."""
    changed = df.withColumns({c: F.when(segment, new).otherwise(F.col(c)) for c, new in changes.items()})
    now = predict(df, model, config).select(F.lit(0).alias("side"), by, "predicted")
    then = predict(changed, model, config).select(F.lit(1).alias("side"), by, "predicted")
    sides = positive_rate(now.unionAll(then), "predicted", 1, by, "side")
    return (
        sides.groupBy(by)
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("n_rows"))).alias("n_rows"),
            F.max(F.when(F.col("side") == 0, F.col("positive_rate"))).alias("rate_now"),
            F.max(F.when(F.col("side") == 1, F.col("positive_rate"))).alias("rate_then"),
        )
        .withColumn("rate_change", F.col("rate_then") - F.col("rate_now"))
    )
