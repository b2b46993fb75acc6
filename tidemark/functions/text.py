"""Text made from rows, and fields taken from logged JSON responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks in a prompt template.
PREDICTION_MARK = "{{prediction}}"
PROFILE_MARK = "{{customer_lines}}"

# Texts used where a response names nothing.
NO_CODE = "N/A"
NO_DETAIL = "No details available"
NO_FINISH_REASON = "unknown"

_GUARD = "array<struct<flagged: boolean, categories: map<string, boolean>>>"
RESPONSE_SCHEMA = (
    "error_code string, detail string, message string, "
    "choices array<struct<message: struct<content: string>>>"
)
DETAIL_SCHEMA = f"finishReason string, input_guardrail {_GUARD}, output_guardrail {_GUARD}"


def identifier(user: Column) -> Column:
    """Name safe for a schema: the part before @, lower case, other signs as underscores."""
    local = F.lower(F.split_part(user, F.lit("@"), F.lit(1)))
    return F.btrim(F.regexp_replace(local, "[^a-z0-9]", "_"), F.lit("_"))


def version_tag(name: Column, version: Column) -> Column:
    return F.concat_ws("_v", name, version.cast("string"))


def percent_text(value: Column, digits: int = 1) -> Column:
    """The share as a percentage, halves rounded up."""
    # the format alone writes 0.45, which as a product is 0.44999999999999996, as 0.4
    scale = float(10**digits)
    rounded = F.round((value * 100).cast("double") * scale) / scale
    return F.format_string(f"%.{digits}f%%", rounded + F.lit(0.0))


def range_text(low: Column, high: Column) -> Column:
    """`[low, high]` with two decimals; `nan` on both sides when there is no value."""
    # -0.0, and what rounds to it, would be written with its sign
    sides = [F.round(side.cast("double"), 2) + F.lit(0.0) for side in (low, high)]
    text = F.format_string("[%.2f, %.2f]", *sides)
    return F.when(low.isNull(), F.lit("[nan, nan]")).otherwise(text)


def profile_lines(df: DataFrame, key: str, columns: list[str] | None = None) -> Column:
    """One `  name: value` line per column, the key left out; missing values read `None`."""
    names = [c for c in (columns or df.columns) if c != key]
    return F.concat_ws(
        "\n",
        *[
            F.concat(F.lit(f"  {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None")))
            for c in names
        ],
    )


def prompt_text(template: str, prediction: Column, lines: Column) -> Column:
    """Template with the prediction and the profile lines put in place of the two marks."""
    # the prediction goes in first, so that marks inside the profile stay as they are
    filled = F.replace(F.lit(template), F.lit(PREDICTION_MARK), F.coalesce(prediction.cast("string"), F.lit("None")))
    return F.replace(filled, F.lit(PROFILE_MARK), lines)


def _flagged(guards: Column) -> Column:
    """Names of the true categories of all flagged guards, comma separated."""
    flagged = F.filter(F.coalesce(guards, F.array()), lambda g: F.coalesce(g["flagged"], F.lit(False)))
    names = F.transform(
        flagged,
        lambda g: F.map_keys(
            F.map_filter(
                F.coalesce(g["categories"], F.create_map().cast("map<string,boolean>")),
                lambda _, on: F.coalesce(on, F.lit(False)),
            )
        ),
    )
    return F.array_join(F.flatten(names), ", ")


def flatten_responses(df: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """Logged responses as flat columns: the first choice on status 200, error fields otherwise."""
    failed = F.col(status) != 200
    parsed = df.withColumn("_r", F.from_json(body, RESPONSE_SCHEMA))
    detail = F.coalesce(F.col("_r.detail"), F.col("_r.message"), F.lit(NO_DETAIL))
    parsed = parsed.withColumn("_text", F.when(failed, detail))
    # `detail` may be an object or an object written as text; plain text gives no struct fields
    is_object = F.json_object_keys("_text").isNotNull()
    parsed = parsed.withColumn("_d", F.when(is_object, F.from_json("_text", DETAIL_SCHEMA)))
    return parsed.select(
        *[c for c in df.columns if c != body],
        F.when(failed, F.coalesce(F.col("_r.error_code"), F.lit(NO_CODE))).alias("error_code"),
        F.when(is_object, F.coalesce(F.col("_d.finishReason"), F.lit(NO_FINISH_REASON))).alias("finish_reason"),
        F.when(is_object, _flagged(F.col("_d.input_guardrail"))).alias("flagged_input"),
        F.when(is_object, _flagged(F.col("_d.output_guardrail"))).alias("flagged_output"),
        F.when(failed & ~is_object, F.col("_text")).alias("error_message"),
        F.when(~failed, F.col("_r.choices")[0]["message"]["content"]).alias("content"),
    )
