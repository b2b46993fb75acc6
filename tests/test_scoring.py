import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import CONFIG, customers
from tidemark.operators import quality, scoring
from tidemark.operators.features import prepare
from tidemark.operators.models import TrainingSet, train_model
from tidemark.plans import queries_models
from tidemark.sources.feature_table import lookup

TS = datetime(2026, 5, 7, 9)


@pytest.fixture(scope="module")
def fitted(spark):
    data = TrainingSet(customers(spark, 200), CONFIG)
    result = {
        1: train_model(data, "logistic_regression", "b").model,
        2: train_model(data, "random_forest", "b", hyper={"n_estimators": 5, "max_depth": 3}).model,
    }
    data.close()
    return result


@pytest.fixture(scope="module")
def rows(spark):
    return customers(spark, 150, seed=7).cache()


def test_scored_table_keeps_rows_and_columns(rows, fitted):
    out = scoring.score_table(rows, fitted[1], CONFIG, "m_v1", TS)
    assert out.columns == [*rows.columns, "prediction", "prediction_prob", "model_id", "inference_ts"]
    assert out.drop("prediction", "prediction_prob", "model_id", "inference_ts").exceptAll(rows).count() == 0
    assert out.count() == rows.count()
    assert quality.failed_checks(quality.check_scored(out, CONFIG)).count() == 0
    assert {r.prediction for r in out.select("prediction").distinct().collect()} == {"Yes", "No"}
    assert out.select("inference_ts").distinct().first()[0] == TS


def test_unlabelled_missing_and_unseen_values_are_scored(rows, fitted):
    odd = rows.drop("Churn").withColumns(
        {"Contract": F.lit("Five year"), "TotalCharges": F.lit(None).cast("double"), "gender": F.lit(None).cast("string")}
    )
    out = scoring.score_table(odd, fitted[1], CONFIG, "m_v1", TS)
    assert out.where("prediction_prob between 0 and 1").count() == 150


def test_text_numbers_are_scored_like_numbers(rows, fitted):
    as_text = rows.withColumn("TotalCharges", F.col("TotalCharges").cast("string"))
    a = scoring.predict(rows, fitted[1], CONFIG).select("customerID", "prob")
    b = scoring.predict(as_text, fitted[1], CONFIG).select("customerID", "prob")
    assert a.exceptAll(b).count() == 0
    blank = scoring.predict(rows.withColumn("TotalCharges", F.lit("")), fitted[1], CONFIG)
    assert blank.where("prob is null").count() == 0


def test_same_scores_for_any_partitioning(rows, fitted):
    a = scoring.predict(rows.repartition(2), fitted[1], CONFIG).select("customerID", "prob")
    b = scoring.predict(rows.repartition(8), fitted[1], CONFIG).select("customerID", "prob")
    assert a.exceptAll(b).count() == 0


def test_score_by_key_equals_scoring_the_table(rows, fitted):
    whole = scoring.score_table(rows.drop("Churn"), fitted[1], CONFIG, "m", TS).select("customerID", "prediction_prob")
    keyed = scoring.score_keys(rows.select("customerID"), rows.drop("Churn"), fitted[1], CONFIG, "m", TS)
    assert keyed.select("customerID", "prediction_prob").exceptAll(whole).count() == 0
    unknown = rows.select("customerID").limit(1).withColumn("customerID", F.lit("nobody"))
    assert scoring.score_keys(unknown, rows.drop("Churn"), fitted[1], CONFIG, "m", TS).count() == 1
    assert lookup(unknown, rows, "customerID").first().tenure is None


def test_canary(rows, fitted):
    out = scoring.canary_score(rows, fitted, 1, 2, CONFIG, "m", percent=30, inference_ts=TS)
    assert out.count() == 150
    routed = {r.route: r["count"] for r in scoring.canary_route(rows, "customerID", 30).groupBy("route").count().collect()}
    by_model = {r.model_id: r["count"] for r in out.groupBy("model_id").count().collect()}
    assert by_model == {"m_v1": routed["stable"], "m_v2": routed["canary"]}
    same = scoring.canary_score(rows, fitted, 2, 2, CONFIG, "m", inference_ts=TS)
    first = scoring.canary_score(rows, fitted, None, 2, CONFIG, "m", inference_ts=TS)
    for all_new in (same, first):
        assert [r.model_id for r in all_new.select("model_id").distinct().collect()] == ["m_v2"]
    assert scoring.canary_shares(1, 2) == {1: 90, 2: 10}


def test_what_if_changes_only_the_segment(rows, fitted):
    found = scoring.what_if(
        rows, fitted[1], CONFIG, F.col("Contract") == "Month-to-month", {"tenure": F.lit(72)}, "Contract"
    )
    for r in found.collect():
        if r.Contract == "Month-to-month":
            assert r.rate_change < 0
        else:
            assert r.rate_change == 0


def test_scoring_never_collects(rows, fitted, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(*_, **__):
        raise AssertionError("rows must stay on the executors")

    monkeypatch.setattr(DataFrame, "collect", refuse)
    monkeypatch.setattr(DataFrame, "toPandas", refuse)
    out = scoring.score_table(rows, fitted[1], CONFIG, "m_v1", TS)
    report = quality.check_scored(out, CONFIG)
    monkeypatch.undo()
    assert report.count() == 7


def test_a_saved_model_is_compared_on_the_same_rows(spark, monkeypatch):
    """Rows whose numbers change when computed again, as sums in order of arrival do, and keys that repeat."""
    given = queries_models.customers
    shaken = F.udf(lambda x: x and x * (1 + random.random() * 1e-6), "double").asNondeterministic()

    def unsteady(spark, sf):
        rows = given(spark, sf)
        return rows.unionByName(rows.limit(20)).withColumn("spend", shaken("spend"))

    monkeypatch.setattr(queries_models, "customers", unsteady)
    found = queries_models.saved_model(spark, "/root/testdata/sf0.001").first()
    assert tuple(found) == (unsteady(spark, "/root/testdata/sf0.001").count(), 0)


def test_different_models_score_rows_differently(rows, fitted):
    prepared = prepare(rows, CONFIG, keep_key=True)
    assert tuple(scoring.score_differences(prepared, fitted[1], fitted[1]).first()) == (150, 0)
    assert scoring.score_differences(prepared, fitted[1], fitted[2]).first().n_different > 100
