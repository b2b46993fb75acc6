"""Checks of an input table and of a scored table, as reports of one row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.numeric import is_missing, is_positive, rate, to_number
from tidemark.functions.text import percent_text, range_text

# Columns a scored table must have.
SCORED_COLUMNS = ("prediction", "prediction_prob", "model_id", "inference_ts")


def _line(name: str, passed: Column, actual: Column, details: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        actual.cast("string").alias("actual_value"),
        F.lit(details).alias("details"),
    )


def _rate_text(value: Column) -> Column:
    return F.coalesce(F.when(value.isNotNull(), percent_text(value)), F.lit("nan%"))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required minus present columns, read from the schema without a job."""
    present = set(df.columns)
    return [c for c in required if c not in present]


# Check names and the wording of their details are fixed values: other tools read the report.
def check_input(df: DataFrame, config: Config) -> DataFrame:
    """Quality report of a raw table: check_name, passed, actual_value, details.

    All figures come from one aggregation; only the columns that are checked are read.
    """
    present = set(df.columns)
    ranged = {c: bounds for c, bounds in config.ranges.items() if c in present}
    watched = [c for c in config.null_rate_columns if c in present]

    figures = [F.count("*").alias("n")]
    for c in ranged:
        figures += [F.min(to_number(df, c)).alias(f"low_{c}"), F.max(to_number(df, c)).alias(f"high_{c}")]
    if config.target in present:
        figures.append(rate(is_positive(F.col(config.target), config.positive)).alias("positive_rate"))
    figures += [rate(is_missing(df, c)).alias(f"null_{c}") for c in watched]

    missing = missing_columns(df, [*config.features, config.target])
    lines = [
        _line("row_count_positive", F.col("n") > 0, F.col("n"), "Dataset must have at least 1 row"),
        _line(
            "required_columns_present",
            F.lit(not missing),
            F.lit(str(missing)),
            f"Missing: {missing}" if missing else "All required columns present",
        ),
    ]
    for c, (low, high) in ranged.items():
        inside = (F.col(f"low_{c}") >= low) & (F.col(f"high_{c}") <= high)
        # a column without any number has nothing out of range
        lines.append(
            _line(
                f"{c}_in_range",
                F.coalesce(inside, F.lit(True)),
                range_text(F.col(f"low_{c}"), F.col(f"high_{c}")),
                f"Expected [{low}, {high}]",
            )
        )
    if config.target in present:
        low, high = config.rate_bounds
        lines.append(
            _line(
                "positive_rate_in_range",
                F.col("positive_rate").between(low, high),
                _rate_text(F.col("positive_rate")),
                f"Expected between {low:.0%} and {high:.0%}",
            )
        )
    for c in watched:
        lines.append(
            _line(
                f"{c}_null_rate_low",
                F.col(f"null_{c}") < config.null_rate_limit,
                _rate_text(F.col(f"null_{c}")),
                f"Null rate should be < {config.null_rate_limit:.0%}",
            )
        )
    return df.agg(*figures).select(F.inline(F.array(*lines)))


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))


def summarise_checks(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if("passed").alias("n_passed"), F.count("*").alias("n_checks"))


def require_passed(report: DataFrame) -> None:
    """ValueError that names the failed checks; the report has a row per check, never per record."""
    failed = [row.check_name for row in failed_checks(report).select("check_name").collect()]
    if failed:
        raise ValueError(f"The table did not pass: {failed}")


def check_scored(df: DataFrame, config: Config) -> DataFrame:
    """Report on a scored table: required columns, valid values, probability and class in agreement."""
    missing = missing_columns(df, list(SCORED_COLUMNS))
    lines = [
        _line(
            "required_columns_present",
            F.lit(not missing),
            F.lit(str(missing)),
            f"Missing: {missing}" if missing else "All required columns present",
        )
    ]
    present = set(SCORED_COLUMNS) - set(missing)
    prediction, prob, model = F.col("prediction"), F.col("prediction_prob"), F.col("model_id")
    positive = prediction.eqNullSafe(F.lit(config.positive))
    rules: list[tuple[str, set[str], Column, str]] = [
        (
            "prediction_valid",
            {"prediction"},
            ~F.coalesce(prediction.isin(config.positive, config.negative), F.lit(False)),
            f"Expected one of {config.positive}, {config.negative}",
        ),
        (
            "prediction_prob_in_range",
            {"prediction_prob"},
            ~F.coalesce(prob.between(0.0, 1.0), F.lit(False)),
            "Expected [0, 1]",
        ),
        ("model_id_present", {"model_id"}, model.isNull() | (model == ""), "Must not be null or empty"),
        ("inference_ts_present", {"inference_ts"}, F.col("inference_ts").isNull(), "Must not be null"),
        (
            "high_prob_is_positive",
            {"prediction", "prediction_prob"},
            (prob > 0.5) & ~positive,
            "Probability above 0.5 must be positive",
        ),
        (
            "low_prob_is_negative",
            {"prediction", "prediction_prob"},
            (prob < 0.5) & positive,
            "Probability below 0.5 must not be positive",
        ),
    ]
    rules = [rule for rule in rules if rule[1] <= present]
    figures = [F.count_if(violation).alias(name) for name, _, violation, _ in rules]
    lines += [_line(name, F.col(name) == 0, F.col(name), details) for name, _, _, details in rules]
    return df.agg(F.count("*").alias("n"), *figures).select(F.inline(F.array(*lines)))
