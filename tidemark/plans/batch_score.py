"""Batch scoring: table, model by alias, append to the scored log."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import Config
from tidemark.operators.scoring import score_table
from tidemark.sources import scored_log
from tidemark.sources.registry import CHAMPION, Registry
from tidemark.sources.tables import read_table


def run_batch_scoring(
    spark: SparkSession,
    config: Config,
    prefix: str,
    default_source: str,
    source: str | None = None,
    output: str | None = None,
    alias: str = CHAMPION,
    inference_ts: datetime | None = None,
) -> DataFrame:
    """Score the source table with the aliased model and append the rows to the log; returns the rows.

    The time of the batch is fixed once, so the returned frame, lazy as it is, has the rows that were logged.
    """
    inference_ts = inference_ts or datetime.now(timezone.utc)
    rows = read_table(spark, default_source, source)
    model, version = Registry(spark, prefix).load(config.model_name, alias)
    scored = score_table(rows, model, config, f"{config.model_name}_v{version}", inference_ts)
    scored_log.append(scored, output or f"{prefix}_{config.log_suffix}")
    return scored
