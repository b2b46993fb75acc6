"""Tables in the roles the operators expect, made from the given star schema.

Every DataFrame here has its SQL twin, so that a result can be checked by another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Config

CUTOFF = "2001-01-01"
EARLIER_CUTOFF = "2000-01-01"
BASELINE_END = "2024-01-16"
SHIFT_START = "2024-01-24"
#: Rows of a fitting task, so that the tasks of a fit grow with its table.
FIT_ROWS = 5_000

CUSTOMERS = Config(
    key="c_custkey",
    target="lapsed",
    numeric=("n_orders", "spend", "acctbal", "days_since"),
    categorical=("segment", "region", "nation", "debtor"),
    as_string=("debtor",),
    ranges={"n_orders": (0, 1000), "spend": (0.0, 1e8), "acctbal": (0.0, 5000.0)},
    rate_bounds=(0.10, 0.60),
    null_rate_columns=("n_orders", "acctbal"),
    model_name="lapse_classifier",
    fit_rows=FIT_ROWS,
)

DOCUMENTS = Config(
    key="doc_id",
    target="quality",
    positive=1,
    negative=0,
    numeric=("n_chars",),
    categorical=("lang", "source"),
    model_name="quality_classifier",
    fit_rows=FIT_ROWS,
)

EVENTS = Config(
    key="event_id",
    target="actual",
    positive="Yes",
    numeric=("amount",),
    categorical=("event_type",),
    model_name="event_classifier",
    fit_rows=FIT_ROWS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF) -> DataFrame:
    """One row per customer: order history before the cutoff, and whether they lapsed after it.

    A negative balance counts as unknown; customers without any order have no label.
    """
    before = F.col("o_orderdate") < F.to_timestamp_ntz(F.lit(cutoff))
    history = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count_if(before).alias("n_before"),
            F.sum(F.when(before, F.col("o_totalprice"))).alias("spend"),
            F.max(F.when(before, F.col("o_orderdate"))).alias("last_order"),
            F.count_if(~before).alias("n_after"),
        )
    )
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(history, "c_custkey", "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "c_custkey",
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("nation"),
            F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("debtor"),
            F.when(F.col("n_before") > 0, F.col("n_before").cast("int")).alias("n_orders"),
            F.col("spend"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
            F.datediff(F.lit(cutoff).cast("date"), F.col("last_order").cast("date")).alias("days_since"),
            F.when(F.col("n_after") == 0, F.lit("Yes")).when(F.col("n_after") > 0, F.lit("No")).alias("lapsed"),
        )
    )


def customers_sql(cutoff: str = CUTOFF) -> str:
    return f"""
      SELECT c_custkey, c_mktsegment AS segment, r_name AS region, n_name AS nation,
             CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS debtor,
             CASE WHEN n_before > 0 THEN CAST(n_before AS INTEGER) END AS n_orders,
             spend,
             CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal,
             CAST(date_diff('day', CAST(last_order AS DATE), DATE '{cutoff}') AS INTEGER) AS days_since,
             CASE WHEN n_after = 0 THEN 'Yes' WHEN n_after > 0 THEN 'No' END AS lapsed
      FROM customer
      LEFT JOIN (
        SELECT o_custkey,
               count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{cutoff}') AS n_before,
               sum(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '{cutoff}') AS spend,
               max(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '{cutoff}') AS last_order,
               count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{cutoff}') AS n_after
        FROM orders GROUP BY o_custkey
      ) ON o_custkey = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey"""


def scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that have a label, with two fixed scores in place of fitted models."""
    return (
        customers(spark, sf_dir)
        .where(F.col("lapsed").isNotNull())
        .select(
            "c_custkey",
            "segment",
            (F.col("lapsed") == "Yes").cast("int").alias("label"),
            # `least` skips nulls, so the missing case comes first
            F.when(F.col("days_since").isNull(), 0.5)
            .otherwise(F.least(F.lit(1.0), F.col("days_since") / 365.0))
            .alias("prob_champion"),
            F.coalesce(1.0 / (1.0 + F.col("n_orders") / 8.0), F.lit(0.5)).alias("prob_challenger"),
        )
    )


SCORED_CUSTOMERS_SQL = f"""
      SELECT c_custkey, segment, CASE WHEN lapsed = 'Yes' THEN 1 ELSE 0 END AS label,
             coalesce(CASE WHEN days_since IS NOT NULL
                           THEN least(1e0, days_since / 365e0) END, 5e-1) AS prob_champion,
             coalesce(1e0 / (1e0 + n_orders / 8e0), 5e-1) AS prob_challenger
      FROM ({customers_sql()}) WHERE lapsed IS NOT NULL"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a scored log: amounts grow from a known day on; sign-ups never get their true label."""
    shifted = F.when(F.col("ts") >= F.to_timestamp_ntz(F.lit(SHIFT_START)), F.col("value") * 1.75)
    amount = F.when(F.col("value") >= 2, shifted.otherwise(F.col("value")))
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("inference_ts"),
        "event_type",
        amount.alias("amount"),
        F.when(F.coalesce(amount, F.lit(0.0)) > 50, F.lit("Yes")).otherwise(F.lit("No")).alias("prediction"),
        F.when(F.col("event_type") != "signup", F.when(F.col("value") > 35 + k * 0.3, "Yes").otherwise("No")).alias(
            "actual"
        ),
    )


EVENT_LOG_SQL = f"""
      SELECT event_id, ts AS inference_ts, event_type, amount,
             CASE WHEN coalesce(amount, 0e0) > 50 THEN 'Yes' ELSE 'No' END AS prediction,
             CASE WHEN event_type <> 'signup'
                  THEN CASE WHEN value > 35 + k * 3e-1 THEN 'Yes' ELSE 'No' END END AS actual
      FROM (
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CASE WHEN value >= 2
                    THEN CASE WHEN ts >= TIMESTAMP '{SHIFT_START}' THEN value * 175e-2 ELSE value END END AS amount
        FROM events)"""


def baseline_and_current(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Days before and from the end of the baseline."""
    end = F.to_timestamp_ntz(F.lit(BASELINE_END))
    return log.where(F.col("inference_ts") < end), log.where(F.col("inference_ts") >= end)


def runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run log of one run per order, with metrics from its line items."""
    run_rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.date_format("o_orderdate", "yyyy").alias("batch_id"),
        F.col("o_orderpriority").alias("model_type"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING").alias("status"),
        F.col("o_orderdate").alias("started_at"),
    )
    per_run = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("run_id"))
        .agg(
            F.round(F.avg("l_discount") * 10, 6).alias("test_f1"),
            F.round(F.avg("l_tax") * 10, 6).alias("test_recall"),
            F.round(F.max("l_quantity") / 50, 6).alias("test_precision"),
        )
    )
    names = ("test_f1", "test_recall", "test_precision")
    pairs = [F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names]
    return run_rows, per_run.select("run_id", F.inline(F.array(*pairs)))


RUNS_SQL = """
      SELECT CAST(o_orderkey AS VARCHAR) AS run_id, strftime(o_orderdate, '%Y') AS batch_id,
             o_orderpriority AS model_type,
             CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' ELSE 'RUNNING' END AS status,
             o_orderdate AS started_at
      FROM orders"""

RUN_METRICS_SQL = """
      SELECT CAST(l_orderkey AS VARCHAR) AS run_id, round(avg(l_discount) * 10, 6) AS test_f1,
             round(avg(l_tax) * 10, 6) AS test_recall, round(max(l_quantity) / 50, 6) AS test_precision
      FROM lineitem GROUP BY l_orderkey"""


def registry_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Alias, version and run tables: each event sets an alias of its user's model."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("model_"), "user_id").alias("name"),
        F.col("event_type").alias("alias"),
        (F.get_json_object("props", "$.k").cast("int") + 1).alias("version"),
        F.col("ts").alias("set_at"),
        "event_id",
    )
    aliases = events.drop("event_id")
    versions = events.groupBy("name", "version").agg(
        F.concat(F.lit("run_"), F.min("event_id")).alias("run_id"), F.min("set_at").alias("created_at")
    )
    run_rows = events.select(F.concat(F.lit("run_"), "event_id").alias("run_id"), F.col("alias").alias("model_type"))
    return aliases, versions, run_rows


ALIASES_SQL = """
      SELECT 'model_' || user_id AS name, event_type AS alias,
             CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS version, ts AS set_at, event_id
      FROM events"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response log made of documents: toxic ones are refused, poor ones hit a limit, others are answered."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    refused = F.coalesce(F.col("toxic") == 1, F.lit(False))
    limited = F.coalesce(F.col("quality") == 0, F.lit(False)) & ~refused
    detail = F.struct(
        F.lit("input_guardrail_triggered").alias("finishReason"),
        F.array(
            F.struct(
                F.lit(True).alias("flagged"),
                F.create_map(
                    F.lit("toxic"), F.lit(True), F.lit("low_quality"), F.col("quality") == 0
                ).alias("categories"),
            )
        ).alias("input_guardrail"),
    )
    code = F.lit("BAD_REQUEST").alias("error_code")
    # the detail comes as an object for one half of the languages, and as an encoded text for the other
    as_object = F.to_json(F.struct(code, detail.alias("detail")))
    as_text = F.to_json(F.struct(code, F.to_json(detail).alias("detail")))
    answer = F.struct(F.struct(F.col("text").alias("content")).alias("message"))
    body = (
        F.when(refused & F.col("lang").isin("en", "de"), as_object)
        .when(refused, as_text)
        .when(limited, F.to_json(F.struct(F.concat(F.lit("limit reached by "), "source").alias("message"))))
        .otherwise(F.to_json(F.struct(F.array(answer).alias("choices"))))
    )
    status = F.when(refused, 400).when(limited, 429).otherwise(200)
    return docs.select("doc_id", status.alias("status"), body.alias("body"))
