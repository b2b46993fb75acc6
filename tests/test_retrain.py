from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import CONFIG, customers
from tidemark.plans.batch_score import run_batch_scoring
from tidemark.plans.retrain import draw_holdout, gate_candidate, retrain, training_rows
from tidemark.session import scratch_path
from tidemark.sources.registry import Registry

SMALL = CONFIG.with_(
    models={
        "logistic_regression": {"C": [0.1], "class_weight": ["balanced"]},
        "random_forest": {"n_estimators": [4], "max_depth": [3], "class_weight": ["balanced"]},
        "gradient_boosted_trees": {"n_estimators": [3], "max_depth": [2]},
    },
    gate_threshold=1.0,
    model_name="churn",
)


def test_holdout_is_a_stratified_share(spark):
    rows = customers(spark, 200)
    held = draw_holdout(rows, CONFIG)
    assert held.count() == 30
    share = rows.where("Churn = 'Yes'").count() / 200
    assert abs(held.where("Churn = 'Yes'").count() - 30 * share) < 1
    kept = training_rows(rows.select("customerID", "Churn"), rows.drop("Churn"), CONFIG, held)
    assert kept.count() == 170 and kept.join(held, "customerID", "left_semi").count() == 0
    assert training_rows(rows.select("customerID", "Churn"), rows.drop("Churn"), CONFIG).count() == 200


def test_retrain_twice_then_score_and_roll_back(spark, database):
    rows = customers(spark, 200)
    held = draw_holdout(rows, SMALL)
    prefix, models = f"{database}.churn", scratch_path(spark, "models")
    first = retrain(spark, rows, SMALL, prefix, models, held)
    assert [r.model_type for r in first.runs] == list(SMALL.models)
    assert first.gate.should_deploy and first.gate.champion["f1"] == 0.0
    assert (first.champion_version, first.serving_version) == (1, 2)
    assert spark.table(f"{prefix}_features").count() == 200
    assert all(r.metrics["n_train"] + r.metrics["n_test"] == 170 for r in first.runs)

    new = customers(spark, 230, seed=5).where("customerID >= 'C0150'")
    second = retrain(spark, rows, SMALL, prefix, models, held, new_rows=new, buckets=4)
    assert second.gate.champion["f1"] > 0.0 and second.champion_version == 3
    assert spark.table(f"{prefix}_features").count() == 230
    kept = spark.table(f"{prefix}_features").join(new.select("customerID", F.col("MonthlyCharges").alias("fresh")), "customerID")
    assert kept.count() == 80 and kept.where("MonthlyCharges != fresh").count() == 0
    assert spark.table(f"{prefix}_runs").count() == 6
    assert spark.table(f"{prefix}_run_params").where("name = 'clf_C'").count() == 2
    assert spark.table(f"{prefix}_run_reports").count() == 6 * 5

    rows.write.saveAsTable(f"{database}.input")
    at = datetime(2026, 5, 7, 9)
    out = run_batch_scoring(spark, SMALL, prefix, f"{database}.input", inference_ts=at)
    assert out.select("model_id").distinct().first()[0] == "churn_v3"
    run_batch_scoring(spark, SMALL, prefix, "nowhere", source=f"{database}.input", alias="serving", inference_ts=at)
    log = spark.table(f"{prefix}_inference_log")
    assert {(r.model_id, r["count"]) for r in log.groupBy("model_id").count().collect()} == {
        ("churn_v3", 200),
        ("churn_v4", 200),
    }
    assert Registry(spark, prefix).roll_back("churn") == 1


def test_failed_checks_stop_before_anything_is_written(spark, database):
    bad = customers(spark, 50).withColumn("tenure", F.lit(-1))
    with pytest.raises(ValueError, match="tenure_in_range"):
        retrain(spark, bad, SMALL, f"{database}.churn", scratch_path(spark, "models"), bad)
    assert spark.catalog.listTables(database) == []


def test_only_a_missing_alias_is_a_first_deployment(spark, database):
    """A champion whose model cannot be read is an error, not a free pass."""
    prefix = f"{database}.churn"
    from test_sources import log

    from tidemark.operators.models import TrainingSet, train_model
    from tidemark.sources.registry import save_model

    rows = customers(spark, 60)
    data = TrainingSet(rows, SMALL)
    path = save_model(train_model(data, "logistic_regression", "b").model, scratch_path(spark, "model"))
    data.close()
    log(spark, prefix, "gone", 0.9, path="/nowhere/model")
    Registry(spark, prefix).promote("churn", "gone")
    with pytest.raises(Exception, match="nowhere"):
        gate_candidate(rows, SMALL, Registry(spark, prefix), path)
