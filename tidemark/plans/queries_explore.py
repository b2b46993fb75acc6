"""Registered queries: exploration, quality reports, coercion and text."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import numeric, text
from tidemark.operators import explore, quality
from tidemark.plans.registered import query
from tidemark.plans.subjects import (
    CUSTOMERS,
    EVENT_LOG_SQL,
    EVENTS,
    customers,
    customers_sql,
    event_log,
    responses,
    table,
)
from tidemark.session import scratch_path
from tidemark.sources.tables import find_tables, load_csv, read_table, use_database

_C = f"WITH c AS ({customers_sql()})"


@query("q_shape", f"{_C} SELECT count(*) AS n_rows, 10 AS n_columns FROM c")
def shape(spark: SparkSession, sf: str) -> DataFrame:
    return explore.shape(customers(spark, sf))


@query(
    "q_sample_rows",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10""",
)
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, f"{sf}/orders.parquet")
    return explore.sample_rows(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "o_orderkey", 10
    )


@query(
    "q_found_tables",
    """SELECT o_orderpriority AS priority, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY 1""",
)
def found_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Orders kept in a database per priority, each made current and left again; then found by table name and read."""
    name, before = f"orders_{uuid.uuid4().hex[:12]}", spark.catalog.currentDatabase()
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    try:
        for row in orders.select("o_orderpriority").distinct().collect():
            use_database(spark, database := f"{name}_{uuid.uuid4().hex[:8]}", scratch_path(spark, database))
            orders.where(F.col("o_orderpriority").eqNullSafe(F.lit(row[0]))).write.saveAsTable(name)
    finally:
        spark.catalog.setCurrentDatabase(before)
    places, _ = find_tables(spark, name)
    kept = reduce(DataFrame.unionByName, [spark.table(place) for place in places]) if places else orders
    return kept.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key")
    )


@query("q_target_counts", f'{_C} SELECT lapsed, count(*) AS "count" FROM c GROUP BY 1')
def target_counts(spark: SparkSession, sf: str) -> DataFrame:
    return explore.counts_by(customers(spark, sf), "lapsed")


_RATE = """count(*) AS n_rows, count(*) FILTER (WHERE lapsed = 'Yes') AS n_positive,
 avg(CASE WHEN lapsed = 'Yes' THEN 1e0 ELSE 0e0 END) AS positive_rate"""
_ROUNDED = "n_rows, n_positive, round(positive_rate, 6) AS positive_rate"


def _round(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("q_positive_rate", f"{_C} SELECT {_ROUNDED} FROM (SELECT {_RATE} FROM c)")
def positive_rate(spark: SparkSession, sf: str) -> DataFrame:
    return _round(explore.positive_rate(customers(spark, sf), "lapsed", "Yes"), "positive_rate")


@query("q_segment_by_target", f'{_C} SELECT segment, lapsed, count(*) AS "count" FROM c GROUP BY 1, 2')
def segment_by_target(spark: SparkSession, sf: str) -> DataFrame:
    return explore.counts_by(customers(spark, sf), "segment", "lapsed")


@query(
    "q_group_means",
    f"""{_C} SELECT lapsed, round(avg(n_orders), 1) AS avg_n_orders, round(avg(acctbal), 2) AS avg_acctbal,
    round(avg(days_since), 1) AS avg_days_since, count(*) AS "count" FROM c GROUP BY 1""",
)
def group_means(spark: SparkSession, sf: str) -> DataFrame:
    return explore.group_means(customers(spark, sf), "lapsed", {"n_orders": 1, "acctbal": 2, "days_since": 1})


_COLUMNS = (
    "c_custkey",
    "segment",
    "region",
    "nation",
    "debtor",
    "n_orders",
    "spend",
    "acctbal",
    "days_since",
    "lapsed",
)
_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count FROM c" for c in _COLUMNS)


@query("q_null_counts", f"{_C} {_NULLS}")
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return explore.null_counts(customers(spark, sf))


@query("q_columns_with_nulls", f"{_C} SELECT * FROM ({_NULLS}) WHERE null_count > 0")
def columns_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return explore.columns_with_nulls(customers(spark, sf))


@query("q_rate_by_segment", f"{_C} SELECT segment, {_ROUNDED} FROM (SELECT segment, {_RATE} FROM c GROUP BY 1)")
def rate_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return _round(explore.positive_rate(customers(spark, sf), "lapsed", "Yes", "segment"), "positive_rate")


@query(
    "q_top_segment",
    f"""{_C} SELECT segment, {_ROUNDED} FROM (SELECT segment, {_RATE} FROM c GROUP BY 1)
    ORDER BY positive_rate DESC, segment LIMIT 1""",
)
def top_segment(spark: SparkSession, sf: str) -> DataFrame:
    rates = explore.positive_rate(customers(spark, sf), "lapsed", "Yes", "segment")
    return explore.top_segment(_round(rates, "positive_rate"), "segment")


@query(
    "q_rate_ratio",
    f"""{_C}, r AS (SELECT region, {_RATE} FROM c GROUP BY 1)
    SELECT region, {_ROUNDED},
     round(positive_rate / (SELECT positive_rate FROM r WHERE region = 'ASIA'), 6) AS ratio_to_base FROM r""",
)
def rate_ratio(spark: SparkSession, sf: str) -> DataFrame:
    rates = explore.positive_rate(customers(spark, sf), "lapsed", "Yes", "region")
    return _round(explore.rate_ratio(rates, "region", "ASIA"), "positive_rate", "ratio_to_base")


@query(
    "q_segment_filter",
    f"""{_C} SELECT c_custkey, segment, region, acctbal, n_orders FROM c
    WHERE segment = 'BUILDING' AND region = 'ASIA' AND acctbal > 70""",
)
def segment_filter(spark: SparkSession, sf: str) -> DataFrame:
    found = explore.segment(
        customers(spark, sf), F.col("segment") == "BUILDING", F.col("region") == "ASIA", F.col("acctbal") > 70
    )
    return found.select("c_custkey", "segment", "region", "acctbal", "n_orders")


@query(
    "q_class_filter",
    f"""{_C} SELECT c_custkey, n_orders, days_since FROM c WHERE lapsed = 'Yes'""",
)
def class_filter(spark: SparkSession, sf: str) -> DataFrame:
    return explore.segment(customers(spark, sf), F.col("lapsed") == "Yes").select(
        "c_custkey", "n_orders", "days_since"
    )


@query(
    "q_histogram",
    f"""{_C} SELECT CAST(floor(days_since / 30e0) AS BIGINT) AS bin,
    floor(days_since / 30e0) * 30e0 AS bin_start, count(*) AS "count"
    FROM c WHERE lapsed = 'Yes' AND days_since IS NOT NULL GROUP BY 1, 2""",
)
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return explore.histogram(customers(spark, sf).where(F.col("lapsed") == "Yes"), "days_since", 30.0)


def _range_line(column: str, low: object, high: object) -> str:
    return f"""SELECT '{column}_in_range' AS check_name,
      coalesce(min({column}) >= {low} AND max({column}) <= {high}, TRUE) AS passed,
      CASE WHEN count({column}) = 0 THEN '[nan, nan]'
           ELSE '[' || format('{{:.2f}}', round(min({column}), 2) + 0e0) || ', '
                || format('{{:.2f}}', round(max({column}), 2) + 0e0) || ']' END AS actual_value,
      'Expected [{low}, {high}]' AS details FROM c"""


def _null_line(column: str) -> str:
    return f"""SELECT '{column}_null_rate_low',
      avg(CASE WHEN {column} IS NULL THEN 1e0 ELSE 0e0 END) < 5e-2,
      format('{{:.1f}}', round(100 * avg(CASE WHEN {column} IS NULL THEN 1e0 ELSE 0e0 END), 1)) || '%',
      'Null rate should be < 5%' FROM c"""


_REPORT = f"""
    SELECT 'row_count_positive' AS check_name, count(*) > 0 AS passed, CAST(count(*) AS VARCHAR) AS actual_value,
           'Dataset must have at least 1 row' AS details FROM c
    UNION ALL SELECT 'required_columns_present', TRUE, '[]', 'All required columns present'
    UNION ALL {_range_line("n_orders", 0, 1000)}
    UNION ALL {_range_line("spend", 0.0, 100000000.0)}
    UNION ALL {_range_line("acctbal", 0.0, 5000.0)}
    UNION ALL SELECT 'positive_rate_in_range',
      avg(CASE WHEN lapsed = 'Yes' THEN 1e0 ELSE 0e0 END) BETWEEN 1e-1 AND 6e-1,
      format('{{:.1f}}', round(100 * avg(CASE WHEN lapsed = 'Yes' THEN 1e0 ELSE 0e0 END), 1)) || '%',
      'Expected between 10% and 60%' FROM c
    UNION ALL {_null_line("n_orders")}
    UNION ALL {_null_line("acctbal")}"""


@query("q_dq_report", f"{_C} {_REPORT}")
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_input(customers(spark, sf), CUSTOMERS)


@query("q_dq_failed", f"{_C} SELECT * FROM ({_REPORT}) WHERE NOT passed")
def dq_failed(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failed_checks(quality.check_input(customers(spark, sf), CUSTOMERS))


@query(
    "q_dq_summary",
    f"{_C} SELECT count(*) FILTER (WHERE passed) AS n_passed, count(*) AS n_checks FROM ({_REPORT})",
)
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.summarise_checks(quality.check_input(customers(spark, sf), CUSTOMERS))


_SCORED_RULES = {
    "prediction_valid": ("prediction NOT IN ('Yes', 'No')", "Expected one of Yes, No"),
    "prediction_prob_in_range": ("NOT coalesce(prediction_prob BETWEEN 0 AND 1, FALSE)", "Expected [0, 1]"),
    "model_id_present": ("model_id IS NULL OR model_id = ''", "Must not be null or empty"),
    "inference_ts_present": ("inference_ts IS NULL", "Must not be null"),
    "high_prob_is_positive": (
        "prediction_prob > 5e-1 AND prediction <> 'Yes'",
        "Probability above 0.5 must be positive",
    ),
    "low_prob_is_negative": (
        "prediction_prob < 5e-1 AND prediction = 'Yes'",
        "Probability below 0.5 must not be positive",
    ),
}


@query(
    "q_scored_checks",
    f"""WITH s AS (SELECT prediction, amount / 1e2 AS prediction_prob, 'event_classifier_v1' AS model_id,
                          inference_ts FROM ({EVENT_LOG_SQL}))
    SELECT 'required_columns_present' AS check_name, TRUE AS passed, '[]' AS actual_value,
           'All required columns present' AS details UNION ALL """
    + " UNION ALL ".join(
        f"""SELECT '{name}', count(*) FILTER (WHERE {rule}) = 0,
        CAST(count(*) FILTER (WHERE {rule}) AS VARCHAR), '{details}' FROM s"""
        for name, (rule, details) in _SCORED_RULES.items()
    ),
)
def scored_checks(spark: SparkSession, sf: str) -> DataFrame:
    log = event_log(spark, sf).select(
        "prediction",
        (F.col("amount") / 100).alias("prediction_prob"),
        F.lit("event_classifier_v1").alias("model_id"),
        "inference_ts",
    )
    return quality.check_scored(log, EVENTS)


@query(
    "q_coerce_numeric",
    """SELECT o_orderstatus, count(*) AS n_rows, count(*) FILTER (WHERE price IS NULL) AS n_null,
       CAST(count(*) FILTER (WHERE price IS NOT NULL AND price BETWEEN 1000 AND 200000) AS BIGINT) AS n_between,
       round(sum(coalesce(price, 0)), 2) AS total
     FROM (SELECT o_orderstatus, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
                  ELSE o_totalprice END AS price FROM orders) GROUP BY 1""",
)
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Prices as text, blank for one priority and the text nan for another, read back as numbers."""
    orders = table(spark, sf, "orders").select(
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", "  ")
        .when(F.col("o_orderpriority") == "2-HIGH", "nan")
        .otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
        .alias("price_text"),
    )
    priced = orders.withColumn("price", numeric.to_number(orders, "price_text"))
    return priced.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_rows"),
        F.count_if(numeric.is_missing(priced, "price")).alias("n_null"),
        F.count_if(F.col("price").between(1000, 200000)).alias("n_between"),
        F.round(F.sum(numeric.fill_null(F.col("price"), 0.0)), 2).alias("total"),
    )


@query(
    "q_csv_load",
    """SELECT o_orderstatus, count(*) AS n_rows, count(price) AS n_priced, round(sum(price), 2) AS total
     FROM (SELECT o_orderstatus, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price
           FROM orders) GROUP BY 1""",
)
def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV with blank prices, and loaded with a fixed schema."""
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", " ")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("price"),
    )
    orders.write.option("header", True).csv(path)
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("price", T.DoubleType()),
        ]
    )
    loaded = load_csv(spark, path, schema, blank_to_null=["price"])
    return loaded.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_rows"), F.count("price").alias("n_priced"), F.round(F.sum("price"), 2).alias("total")
    )


@query(
    "q_identifier",
    r"""SELECT c_custkey, trim(regexp_replace(lower(split_part(
         c_name || '.' || c_mktsegment || '#@Mail.example', '@', 1)), '[^a-z0-9]', '_', 'g'), '_') AS user_id,
        'lapse_classifier_v' || c_nationkey AS model_id FROM customer""",
)
def identifier(spark: SparkSession, sf: str) -> DataFrame:
    mail = F.concat_ws("", "c_name", F.lit("."), "c_mktsegment", F.lit("#@Mail.example"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.identifier(mail).alias("user_id"),
        text.version_tag(F.lit("lapse_classifier"), F.col("c_nationkey")).alias("model_id"),
    )


PROMPT = (
    "The model predicts: {{prediction}}\n\nProfile:\n{{customer_lines}}\n\n"
    "Name the two values that speak most for this prediction, and one thing to do about it."
)
_PROMPT_SQL = PROMPT.replace("\n", "' || chr(10) || '")
_LINES_SQL = " || chr(10) || ".join(
    f"'  {c}: ' || coalesce(CAST({c} AS VARCHAR), 'None')" for c in ("lang", "source", "n_chars", "text")
)


@query(
    "q_prompt_text",
    f"""SELECT doc_id, replace(replace('{_PROMPT_SQL}', '{{{{prediction}}}}',
            CASE WHEN quality = 1 THEN '1' ELSE '0' END), '{{{{customer_lines}}}}', {_LINES_SQL}) AS prompt
        FROM documents LEFT JOIN labels USING (doc_id)""",
)
def prompt_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    lines = docs.select("doc_id", text.profile_lines(docs, "doc_id").alias("lines"))
    scored = lines.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    prediction = F.when(F.col("quality") == 1, 1).otherwise(0)
    return scored.select("doc_id", text.prompt_text(PROMPT, prediction, F.col("lines")).alias("prompt"))


@query(
    "q_response_flatten",
    """SELECT doc_id, CASE WHEN toxic = 1 THEN 400 WHEN quality = 0 THEN 429 ELSE 200 END AS status,
         CASE WHEN toxic = 1 THEN 'BAD_REQUEST' WHEN quality = 0 THEN 'N/A' END AS error_code,
         CASE WHEN toxic = 1 THEN 'input_guardrail_triggered' END AS finish_reason,
         CASE WHEN toxic = 1 THEN CASE WHEN quality = 0 THEN 'toxic, low_quality' ELSE 'toxic' END END AS flagged_input,
         CASE WHEN toxic = 1 THEN '' END AS flagged_output,
         CASE WHEN coalesce(toxic, 0) = 0 AND quality = 0 THEN 'limit reached by ' || source END AS error_message,
         CASE WHEN coalesce(toxic, 0) = 0 AND coalesce(quality, 1) = 1 THEN text END AS content
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def response_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return text.flatten_responses(responses(spark, sf))
