"""Registered queries: metrics, runs, registry, gate, training and scoring."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gate, metrics, scoring
from tidemark.operators.features import LABEL, prepare
from tidemark.operators.models import TrainingSet, grid_search, score, train_model
from tidemark.operators.scoring import canary_route
from tidemark.plans.registered import query, scratch_database
from tidemark.plans.retrain import draw_holdout, retrain
from tidemark.plans.subjects import (
    ALIASES_SQL,
    CUSTOMERS,
    EVENT_LOG_SQL,
    RUN_METRICS_SQL,
    RUNS_SQL,
    SCORED_CUSTOMERS_SQL,
    customers,
    customers_sql,
    event_log,
    registry_rows,
    runs,
    scored_customers,
    table,
)
from tidemark.session import scratch_path
from tidemark.sources import registry, run_log

_S = f"WITH s AS ({SCORED_CUSTOMERS_SQL})"


def confusion_sql(source: str, prob: str, by: str = "") -> str:
    """Counts and ratios of a 0/1 `label` against a probability above one half."""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    ratio = "CASE WHEN {1} > 0 THEN CAST({0} AS DOUBLE) / ({1}) ELSE 0e0 END"
    return f"""
      SELECT *, {ratio.format("(tp + tn)", "tp + fp + fn + tn")} AS accuracy,
        {ratio.format("tp", "tp + fp")} AS "precision", {ratio.format("tp", "tp + fn")} AS recall,
        {ratio.format("(2 * tp)", "2 * tp + fp + fn")} AS f1
      FROM (SELECT {lead}
        count(*) FILTER (WHERE label = 1 AND {prob} > 5e-1) AS tp,
        count(*) FILTER (WHERE label = 0 AND {prob} > 5e-1) AS fp,
        count(*) FILTER (WHERE label = 1 AND NOT {prob} > 5e-1) AS fn,
        count(*) FILTER (WHERE label = 0 AND NOT {prob} > 5e-1) AS tn
      FROM {source} WHERE label IS NOT NULL {group})"""


def auc_sql(source: str, prob: str) -> str:
    """Rank form of the area under the curve, ties counted half."""
    return f"""
      SELECT (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2e0) / (p * n) AS auc FROM (
        SELECT label, rank() OVER (ORDER BY {prob}) + (count(*) OVER (PARTITION BY {prob}) - 1) / 2e0 AS r,
          count(*) FILTER (WHERE label = 1) OVER () AS p, count(*) FILTER (WHERE label = 0) OVER () AS n
        FROM {source}) GROUP BY p, n"""


def _predicted(prob: str) -> Column:
    return (F.col(prob) > 0.5).cast("int")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


_RATIOS = ", ".join(f'round("{m}", 6) AS "{m}"' for m in metrics.METRICS)


@query("q_confusion_metrics", f"{_S} SELECT tp, fp, fn, tn, {_RATIOS} FROM ({confusion_sql('s', 'prob_champion')})")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    found = metrics.confusion_metrics(scored_customers(spark, sf), F.col("label"), _predicted("prob_champion"))
    return _rounded(found, *metrics.METRICS)


@query(
    "q_roc_auc",
    f"""{_S} SELECT (SELECT count(*) FROM s) AS n_rows, round((SELECT auc FROM ({auc_sql('s', 'prob_champion')})), 6)
        AS auc_champion, round((SELECT auc FROM ({auc_sql('s', 'prob_challenger')})), 6) AS auc_challenger""",
)
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_customers(spark, sf)
    sides = [F.struct(F.lit(p).alias("side"), F.col(p).alias("prob")) for p in ("prob_champion", "prob_challenger")]
    tall = scored.select("label", F.inline(F.array(*sides)))
    areas = {r.side: r.roc_auc for r in metrics.auc_by(tall, "label", "prob", ("side",)).collect()}
    return scored.agg(F.count("*").alias("n_rows")).select(
        "n_rows", *[F.round(F.lit(a), 6).alias(p.replace("prob", "auc")) for p, a in areas.items()]
    )


_REPORT_LINES = """
    SELECT 'kept' AS class, tn / nullif(tn + fn, 0)::DOUBLE AS p, tn / nullif(tn + fp, 0)::DOUBLE AS r,
      2 * tn / nullif(2 * tn + fp + fn, 0)::DOUBLE AS f, tn + fp AS support FROM k
    UNION ALL SELECT 'lapsed', "precision", recall, f1, tp + fn FROM k"""


@query(
    "q_class_report",
    f"""{_S}, k AS ({confusion_sql('s', 'prob_champion')}), l AS ({_REPORT_LINES}),
     c AS (SELECT class, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(f, 0) AS f, support FROM l)
    SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, support FROM (
      SELECT * FROM c
      UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, tp + fp + fn + tn FROM k
      UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM c
      UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
        sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM c)""",
)
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.class_report(
        scored_customers(spark, sf), F.col("label"), _predicted("prob_champion"), ("kept", "lapsed")
    )
    return _rounded(report, "precision", "recall", "f1")


@query(
    "q_metric_delta",
    f"""{_S}, a AS (UNPIVOT (SELECT accuracy, "precision", recall, f1 FROM ({confusion_sql('s', 'prob_challenger')}))
          ON accuracy, "precision", recall, f1 INTO NAME name VALUE v),
     b AS (UNPIVOT (SELECT accuracy, "precision", recall, f1 FROM ({confusion_sql('s', 'prob_champion')}))
          ON accuracy, "precision", recall, f1 INTO NAME name VALUE v)
    SELECT name, round(a.v, 6) AS challenger, round(b.v, 6) AS champion, round(a.v - b.v, 6) AS delta
    FROM a JOIN b USING (name)""",
)
def metric_delta(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_customers(spark, sf)

    def long(prob: str) -> DataFrame:
        wide = metrics.confusion_metrics(scored, F.col("label"), _predicted(prob))
        pairs = [F.struct(F.lit(m).alias("name"), F.col(m).alias("value")) for m in metrics.METRICS]
        return wide.select(F.inline(F.array(*pairs)))

    delta = metrics.metric_delta(long("prob_challenger"), long("prob_champion"))
    return _rounded(delta, "challenger", "champion", "delta")


@query(
    "q_rate_shift",
    f"""WITH e AS ({EVENT_LOG_SQL}), r AS (
      SELECT avg(CASE WHEN prediction = 'Yes' THEN 1e0 ELSE 0e0 END)
               FILTER (WHERE inference_ts < TIMESTAMP '2024-01-16') AS b,
             avg(CASE WHEN prediction = 'Yes' THEN 1e0 ELSE 0e0 END)
               FILTER (WHERE inference_ts >= TIMESTAMP '2024-01-24') AS a FROM e)
    SELECT round(b, 6) AS rate_before, round(a, 6) AS rate_after, round(abs(a - b), 6) AS rate_change,
      abs(a - b) > 1e-1 AS shifted FROM r""",
)
def rate_shift(spark: SparkSession, sf: str) -> DataFrame:
    log = event_log(spark, sf)
    before = log.where(F.col("inference_ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    after = log.where(F.col("inference_ts") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    return _rounded(metrics.rate_shift(before, after, "Yes"), "rate_before", "rate_after", "rate_change")


@query(
    "q_best_run",
    f"""SELECT run_id, batch_id, model_type, status, test_f1 AS metric_value
    FROM ({RUNS_SQL}) JOIN ({RUN_METRICS_SQL}) USING (run_id)
    WHERE status = 'FINISHED' ORDER BY test_f1 DESC NULLS LAST, run_id LIMIT 1""",
)
def best_run(spark: SparkSession, sf: str) -> DataFrame:
    run_rows, measured = runs(spark, sf)
    return run_log.best_run(run_rows, measured).drop("started_at")


@query(
    "q_best_run_of_batch",
    f"""SELECT run_id, model_type, test_recall AS metric_value
    FROM ({RUNS_SQL}) JOIN ({RUN_METRICS_SQL}) USING (run_id)
    WHERE status = 'FINISHED' AND batch_id = '1998' ORDER BY test_recall DESC NULLS LAST, run_id LIMIT 1""",
)
def best_run_of_batch(spark: SparkSession, sf: str) -> DataFrame:
    run_rows, measured = runs(spark, sf)
    best = run_log.best_run(run_rows, measured, "test_recall", batch_id="1998")
    return best.select("run_id", "model_type", "metric_value")


@query(
    "q_model_comparison",
    f"""SELECT run_id, model_type, strftime(started_at, '%Y-%m-%d') AS started, test_f1, test_recall, test_precision
    FROM ({RUNS_SQL}) LEFT JOIN ({RUN_METRICS_SQL}) USING (run_id)""",
)
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    run_rows, measured = runs(spark, sf)
    names = ["test_f1", "test_recall", "test_precision"]
    compared = run_log.compare_models(run_rows, measured, names)
    return compared.select("run_id", "model_type", F.date_format("started_at", "yyyy-MM-dd").alias("started"), *names)


_LATEST = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, alias ORDER BY set_at DESC, version DESC) AS n
                   FROM ({ALIASES_SQL})) WHERE n = 1"""


@query(
    "q_alias_lookup",
    f"""SELECT l.name, l.alias, l.version, v.run_id, r.model_type FROM ({_LATEST}) l
    JOIN (SELECT name, version, 'run_' || min(event_id) AS run_id FROM ({ALIASES_SQL}) GROUP BY 1, 2) v
      USING (name, version)
    JOIN (SELECT 'run_' || event_id AS run_id, event_type AS model_type FROM events) r ON r.run_id = v.run_id""",
)
def alias_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return registry.resolve_aliases(*registry_rows(spark, sf))


@query(
    "q_rollback",
    f"""WITH d AS (SELECT name, alias, version, min(set_at) AS begun, max(set_at) AS set_at FROM ({ALIASES_SQL}) GROUP BY 1, 2, 3),
     n AS (SELECT *, row_number() OVER (PARTITION BY name, alias ORDER BY set_at DESC, version DESC) AS n FROM d),
     c AS (SELECT name, alias, version, begun FROM n WHERE n = 1)
    SELECT c.name, c.alias, c.version AS current_version,
      (SELECT d.version FROM d WHERE d.name = c.name AND d.alias = c.alias AND (d.begun, d.version) < (c.begun, c.version)
       ORDER BY d.begun DESC, d.version DESC LIMIT 1) AS previous_version FROM c""",
)
def rollback(spark: SparkSession, sf: str) -> DataFrame:
    return registry.rollback_targets(registry_rows(spark, sf)[0])


@query(
    "q_registered_versions",
    """SELECT event_type AS name, count(*) AS n_versions, 1 AS first_version, CAST(count(*) AS INTEGER) AS last_version,
         count(*) AS n_runs, max(d) AS champion_run
       FROM (SELECT DISTINCT event_type, strftime(ts, '%Y-%m-%d') AS d FROM events) GROUP BY 1""",
)
def registered_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A model per event type with a run per day, registered by jobs at a time: numbers without gaps, read back."""
    days = table(spark, sf, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("d")).distinct()
    wanted = [tuple(r) for r in days.orderBy("d", "event_type").collect()]
    store = registry.Registry(spark, f"{scratch_database(spark)}.m")
    with ThreadPoolExecutor(8) as jobs:
        held = dict(zip(wanted, jobs.map(lambda r: store.register(*r), wanted), strict=True))
    for name, day in {name: day for name, day in wanted}.items():
        store.set_alias(name, registry.CHAMPION, held[name, day])
    versions, aliases = store._table("versions"), registry.latest_aliases(store._table("aliases"))
    champions = aliases.join(versions, ["name", "version"]).select("name", F.col("run_id").alias("champion_run"))
    counted = versions.groupBy("name").agg(
        F.count("*").alias("n_versions"), F.min("version").alias("first_version"), F.max("version").alias("last_version"),
        F.countDistinct("run_id").alias("n_runs"),
    )
    return counted.join(champions, "name")


@query(
    "q_gate",
    f"""{_S}, a AS (SELECT f1, recall FROM ({confusion_sql('s', 'prob_challenger')})),
     b AS (SELECT f1, recall FROM ({confusion_sql('s', 'prob_champion')})),
     v AS (
      SELECT 'f1' AS metric, a.f1 AS x, b.f1 AS y FROM a, b
      UNION ALL SELECT 'recall', a.recall, b.recall FROM a, b
      UNION ALL SELECT 'roc_auc', (SELECT auc FROM ({auc_sql('s', 'prob_challenger')})),
        (SELECT auc FROM ({auc_sql('s', 'prob_champion')}))),
     g AS (SELECT b.f1 - a.f1 <= 5e-2 AS ok, 'Challenger F1=' || format('{{:.4f}}', a.f1) || ' vs Champion F1='
        || format('{{:.4f}}', b.f1) || ' (drop=' || format('{{:.4f}}', b.f1 - a.f1) AS figures FROM a, b)
    SELECT ok AS should_deploy,
      CASE WHEN ok THEN 'Gate PASSED. ' || figures || ' ≤ threshold=0.05).'
           ELSE 'Gate FAILED. ' || figures || ' > threshold=0.05). Challenger will NOT be promoted.' END AS reason,
      metric, round(x, 6) AS challenger, round(y, 6) AS champion, round(x - y, 6) AS delta FROM v, g""",
)
def gate_verdict(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_customers(spark, sf)
    verdict = gate.evaluate_gate(scored, "label", "prob_challenger", "prob_champion")
    return _rounded(gate.gate_rows(verdict, scored), "challenger", "champion", "delta")


@query(
    "q_canary_route",
    """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 10
       THEN 'canary' ELSE 'stable' END AS route FROM orders""",
)
def canary(spark: SparkSession, sf: str) -> DataFrame:
    return canary_route(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


# Models have no twin in SQL: the tests compare them with a direct solution or check what must hold.


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).where(F.col("lapsed").isNotNull())


def _trained(spark: SparkSession, sf: str, name: str) -> DataFrame:
    data = TrainingSet(_labelled(spark, sf), CUSTOMERS)
    try:
        result = train_model(data, name, "query")
    finally:
        data.close()
    rows = [(name, k, v) for k, v in result.metrics.items()]
    return spark.createDataFrame(rows, "model_type string, metric string, value double")


@query("q_train_logistic")
def train_logistic(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(spark, sf, "logistic_regression")


@query("q_train_forest")
def train_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(spark, sf, "random_forest")


@query("q_train_boosted")
def train_boosted(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(spark, sf, "gradient_boosted_trees")


@query("q_grid_search")
def grid(spark: SparkSession, sf: str) -> DataFrame:
    return grid_search(_labelled(spark, sf), CUSTOMERS, "logistic_regression")


def _pipeline(spark: SparkSession, sf: str, name: str = "logistic_regression"):
    data = TrainingSet(_labelled(spark, sf), CUSTOMERS)
    try:
        return train_model(data, name, "query").model
    finally:
        data.close()


@query("q_batch_score")
def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_table(customers(spark, sf), _pipeline(spark, sf), CUSTOMERS, "lapse_classifier_v1")


@query("q_score_by_key")
def score_by_key(spark: SparkSession, sf: str) -> DataFrame:
    everyone = customers(spark, sf).drop("lapsed")
    keys = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return scoring.score_keys(keys, everyone, _pipeline(spark, sf), CUSTOMERS, "lapse_classifier_v1")


@query("q_canary_score")
def canary_score(spark: SparkSession, sf: str) -> DataFrame:
    data = TrainingSet(_labelled(spark, sf), CUSTOMERS)
    try:
        first = train_model(data, "logistic_regression", "query").model
        second = train_model(data, "logistic_regression", "query", hyper={"C": 1.0}).model
    finally:
        data.close()
    scored = scoring.canary_score(customers(spark, sf), {1: first, 2: second}, 1, 2, CUSTOMERS, "lapse_classifier")
    return scored.groupBy("model_id", "prediction").agg(F.count("*").alias("n"))


@query("q_what_if")
def what_if(spark: SparkSession, sf: str) -> DataFrame:
    """What if the customers of one segment had ordered half a year later?"""
    return scoring.what_if(
        customers(spark, sf),
        _pipeline(spark, sf),
        CUSTOMERS,
        F.col("segment") == "BUILDING",
        {"days_since": F.when(F.col("days_since").isNotNull(), F.greatest(F.lit(0), F.col("days_since") - 180))},
        "segment",
    )


@query("q_holdout_gate")
def holdout_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Two fitted models judged on rows that neither has seen."""
    rows = _labelled(spark, sf)
    held = draw_holdout(rows, CUSTOMERS)
    data = TrainingSet(rows.join(held.select("c_custkey"), "c_custkey", "left_anti"), CUSTOMERS)
    try:
        champion = train_model(data, "logistic_regression", "query").model
        challenger = train_model(data, "logistic_regression", "query", hyper={"C": 1.0}).model
    finally:
        data.close()
    scored = prepare(held, CUSTOMERS, keep_key=True)
    for side, model in (("champion", champion), ("challenger", challenger)):
        scored = score(scored, model).drop("predicted").withColumnRenamed("prob", f"{side}_prob")
    return gate.gate_rows(gate.evaluate_gate(scored, LABEL, "challenger_prob", "champion_prob"), scored)


@query("q_retrain")
def retrain_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The whole path on stored tables: checks, feature table, three models, gate, promotion."""
    config = CUSTOMERS.with_(ranges={**CUSTOMERS.ranges, "acctbal": (0.0, 10_000.0)}, null_rate_columns=("n_orders",))
    prefix = f"{scratch_database(spark)}.lapse"
    # source and holdout are stored tables, as they are in practice: every step reads them again
    _labelled(spark, sf).write.format("parquet").saveAsTable(f"{prefix}_source")
    rows = spark.table(f"{prefix}_source")
    draw_holdout(rows, config).write.format("parquet").saveAsTable(f"{prefix}_holdout")
    held = spark.table(f"{prefix}_holdout")
    result = retrain(spark, rows, config, prefix, scratch_path(spark, "models"), held)
    out = [
        (
            r.model_type,
            r.metrics["test_f1"],
            r.metrics["test_roc_auc"],
            r.metrics["test_recall"],
            r.metrics["test_precision"],
            r.metrics["train_f1"],
            result.gate.should_deploy,
            result.champion_version,
        )
        for r in result.runs
    ]
    return spark.createDataFrame(
        out,
        "model_type string, test_f1 double, test_roc_auc double, test_recall double, test_precision double, "
        "train_f1 double, should_deploy boolean, champion_version int",
    )


def _checked(scored: DataFrame) -> DataFrame:
    """Counts that must hold of any scored table: rows, sum of an input, and rows that break a rule."""
    prob, positive = F.col("prediction_prob"), F.col("prediction") == CUSTOMERS.positive
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.sum("n_orders").cast("bigint").alias("n_orders"),
        F.count_if(prob.isNull() | (prob < 0) | (prob > 1)).alias("n_no_probability"),
        F.count_if(positive != (prob > 0.5)).alias("n_other_class"),
        F.count_if(F.col("model_id") != "lapse_classifier_v1").alias("n_other_model"),
        F.count_if(F.col("inference_ts").isNull()).alias("n_no_time"),
    )


_NOTHING_BROKEN = "0::BIGINT AS n_no_probability, 0::BIGINT AS n_other_class, 0::BIGINT AS n_other_model, 0::BIGINT AS n_no_time"


@query(
    "q_batch_score_checks",
    f"SELECT count(*) AS n_rows, CAST(sum(n_orders) AS BIGINT) AS n_orders, {_NOTHING_BROKEN} FROM ({customers_sql()})",
)
def batch_score_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(batch_score(spark, sf))


@query(
    "q_score_by_key_checks",
    f"""SELECT count(*) AS n_rows, CAST(sum(n_orders) AS BIGINT) AS n_orders, {_NOTHING_BROKEN} FROM ({customers_sql()})
     WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
)
def score_by_key_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(score_by_key(spark, sf))


@query(
    "q_train_counts",
    f"""WITH c AS (SELECT count(*) AS n FROM ({customers_sql()}) WHERE lapsed IS NOT NULL)
    SELECT name, value FROM (SELECT 'n_test' AS name, CAST(ceil(0.2e0 * n) AS DOUBLE) AS value FROM c
      UNION ALL SELECT 'n_train', CAST(n - ceil(0.2e0 * n) AS DOUBLE) FROM c)""",
)
def train_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes that a logged training run has in its metrics, read back from the log."""
    prefix = f"{scratch_database(spark)}.counted"
    data = TrainingSet(_labelled(spark, sf), CUSTOMERS)
    try:
        train_model(data, "logistic_regression", "query", prefix, scratch_path(spark, "models"))
    finally:
        data.close()
    return spark.table(f"{prefix}_run_metrics").where("name in ('n_train', 'n_test')").select("name", "value")


@query("q_saved_model", "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM customer")
def saved_model(spark: SparkSession, sf: str) -> DataFrame:
    """A saved and loaded pipeline scores every customer as the fitted one does."""
    fitted = _pipeline(spark, sf)
    loaded = registry.load_model(registry.save_model(fitted, scratch_path(spark, "models")))
    rows = prepare(customers(spark, sf), CUSTOMERS, keep_key=True)
    return scoring.score_differences(rows, fitted, loaded)
