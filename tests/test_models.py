import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from samples import CONFIG, customers
from tidemark.operators import gate, metrics, models
from tidemark.operators.models import TrainingSet, make_classifier, train_model
from tidemark.plans.queries_models import auc_sql


@pytest.fixture(scope="module")
def data(spark):
    training = TrainingSet(customers(spark, 300), CONFIG)
    yield training
    training.close()


def test_factory(spark):
    inner = {name: make_classifier(name, CONFIG).inner(100) for name in models.MODEL_TYPES}
    assert isinstance(inner["logistic_regression"], LogisticRegression)
    assert isinstance(inner["random_forest"], RandomForestClassifier)
    assert isinstance(inner["gradient_boosted_trees"], GBTClassifier)
    assert inner["random_forest"].getMaxDepth() == 5 and inner["random_forest"].getNumTrees() == 100
    assert inner["gradient_boosted_trees"].getStepSize() == 0.05
    assert inner["gradient_boosted_trees"].getSubsamplingRate() == 0.8
    assert abs(inner["logistic_regression"].getRegParam() - 1.0) < 1e-12  # 1 / (0.01 * 100)
    assert make_classifier("random_forest", CONFIG, {"max_depth": None}).inner(1).getMaxDepth() == 30
    with pytest.raises(ValueError, match="No classifier is called"):
        make_classifier("xgboost", CONFIG)


def test_logistic_regression_is_the_penalised_minimum(data):
    """The fitted weights solve the penalised, class-weighted problem that Newton's method solves directly."""
    fitted = data.fit("logistic_regression")
    rows = data.train.select(vector_to_array("features").alias("x"), "label").collect()
    x = np.array([r.x + [1.0] for r in rows])
    y = np.array([r.label for r in rows], dtype=float)
    s = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    c, w = 0.01, np.zeros(x.shape[1])
    penalty = np.ones(x.shape[1])
    penalty[-1] = 0
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = penalty * w + c * x.T @ (s * (p - y))
        hessian = np.diag(penalty) + c * (x.T * (s * p * (1 - p))) @ x
        w -= np.linalg.solve(hessian + 1e-12 * np.eye(len(w)), gradient)
    assert np.allclose(fitted.coefficients.toArray(), w[:-1], atol=1e-4)
    assert abs(fitted.intercept - w[-1]) < 1e-3


@pytest.mark.parametrize("name", models.MODEL_TYPES)
def test_training_gives_metrics_in_range(data, name):
    hyper = {"n_estimators": 5, "max_depth": 3} if name != "logistic_regression" else None
    result = train_model(data, name, "b", hyper=hyper)
    assert result.model_type == name
    assert set(result.metrics) == {
        "test_accuracy",
        "test_f1",
        "test_roc_auc",
        "test_precision",
        "test_recall",
        "train_f1",
        "n_train",
        "n_test",
    }
    assert all(0 <= v <= 1 for k, v in result.metrics.items() if not k.startswith("n_"))
    assert (result.metrics["n_train"], result.metrics["n_test"]) == (240, 60)
    assert [line[0] for line in result.report] == ["not Churn", "Churn", "accuracy", "macro avg", "weighted avg"]


def test_training_needs_a_target(spark):
    with pytest.raises(ValueError, match="no target column"):
        TrainingSet(customers(spark, 10).drop("Churn"), CONFIG)


def test_fitting_tasks_follow_the_rows(spark):
    for rows, wanted in ((100, 3), (1000, 1), (30, 8)):
        training = TrainingSet(customers(spark, 300).repartition(8), CONFIG.with_(fit_partitions=None, fit_rows=rows))
        try:
            assert training.fitting_tasks == wanted and training.train.rdd.getNumPartitions() <= wanted
            assert training.train.count() == 240
        finally:
            training.close()
    assert models.fitting_tasks(spark.range(9), CONFIG.with_(fit_partitions=None)) is None
    assert models.fitting_tasks(spark.range(0), CONFIG.with_(fit_partitions=None, fit_rows=5)) == 1


def test_fitting_tasks_grow_slower_than_the_rows(spark):
    """Tasks of a fit answer the driver hundreds of times each, so their number is what the driver gets."""
    rule = CONFIG.with_(fit_partitions=None, fit_rows=5)
    found = [models.fitting_tasks(spark.range(5 * n), rule) for n in (1, 15, 16, 17, 64, 144, 864, 6400)]
    assert found == [1, 15, 16, 17, 32, 48, 118, 320]


def test_a_boosted_fit_answers_the_driver_from_few_tasks(spark):
    rule = CONFIG.with_(fit_partitions=None, fit_rows=2)
    training = TrainingSet(customers(spark, 300).repartition(200), rule)
    try:
        assert training.train.rdd.getNumPartitions() <= 44
    finally:
        training.close()


def test_fitting_tasks_have_no_plan_behind_them(spark):
    """Each task answers with the metrics of all steps behind its rows; they are stored, dealt as they were."""
    training = TrainingSet(customers(spark, 300).repartition(8), CONFIG.with_(fit_partitions=3))
    try:
        assert "InMemoryTableScan" not in training.train._jdf.queryExecution().executedPlan().toString()
        dealt = training.encoded.where(~F.col("is_test")).coalesce(3).rdd.glom().collect()
        assert training.train.rdd.glom().collect() == dealt and sum(map(len, dealt)) == 240
    finally:
        training.close()


def test_grid_points():
    grid = {"a": [1, 2], "b": ["x"], "c": [None, 5]}
    assert models.first_values(grid) == {"a": 1, "b": "x", "c": None}
    assert len(models.grid_points(grid)) == 4


def test_grid_search_ranks_all_points(spark):
    config = CONFIG.with_(models={"logistic_regression": {"C": [0.01, 1.0], "class_weight": ["balanced"]}}, cv_folds=2)
    found = models.grid_search(customers(spark, 120), config, "logistic_regression").collect()
    assert len(found) == 2
    assert found[0].mean_metric >= found[1].mean_metric
    assert all(0 <= r.mean_metric <= 1 for r in found)


def scored(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.6), (0, 0.1), (1, 0.2), (None, 0.9)]
    return spark.createDataFrame(rows, "label int, prob double")


def test_confusion_counts_leave_unlabelled_rows_out(spark):
    row = metrics.confusion_metrics(scored(spark), F.col("label"), (F.col("prob") > 0.5).cast("int")).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 1, 2, 1)
    assert (row.accuracy, row.precision, row.f1) == (0.4, 0.5, 0.4)
    none = metrics.confusion_metrics(scored(spark).where("label = 0"), F.col("label"), F.lit(0)).first()
    assert (none.precision, none.recall, none.f1, none.accuracy) == (0.0, 0.0, 0.0, 1.0)


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_areas_of_groups_equal_pairs(spark, ranges):
    """Ties within and across ranges, groups of one class, null keys, labels and scores; against all pairs."""
    rows = [(None if i % 13 == 0 else "abc"[i % 3], None if i % 17 == 0 else (i * 7 % 5 == 0) * 1, None if i % 19 == 0 else (i * 31 % 40) / 8 - 1.0) for i in range(400)]
    rows += [("one", 1, 0.5), ("one", 1, 0.25), ("zero", 1, 0.0), ("zero", 0, -0.0)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        frame = spark.createDataFrame(rows, "g string, label int, p double")
        found = {r.g: (r.positives, r.negatives, r.roc_auc) for r in metrics.auc_by(frame, "label", "p", ("g",)).collect()}
        double = frame.withColumn("n", F.lit(3))
        assert {r.g: r.roc_auc for r in metrics.auc_by(double, "label", "p", ("g",), "n").collect()} == {g: a for g, (_, _, a) in found.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for group in {g for g, _, _ in rows}:
        pos, neg = ([p for g, y, p in rows if g == group and y == wanted and p is not None] for wanted in (1, 0))
        area = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None
        assert found[group][:2] == (len(pos), len(neg)) and (found[group][2] is None if area is None else abs(found[group][2] - area) < 1e-12)


def test_roc_auc(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)], "label int, prob double")
    # pairs won: 2 + 1 ties/2 ... counted by hand: (0.9: .5+1+1, 0.4: 0+.5+1) / 6
    assert abs(metrics.roc_auc(df, "label", "prob") - 4 / 6) < 1e-12
    assert metrics.roc_auc(df.where("label = 1"), "label", "prob") is None
    assert "rank()" in auc_sql("t", "p")


def test_rate_shift(spark):
    before = spark.range(100).select(F.when(F.col("id") < 26, "Yes").otherwise("No").alias("prediction"))
    after = spark.range(100).select(F.when(F.col("id") < 45, "Yes").otherwise("No").alias("prediction"))
    row = metrics.rate_shift(before, after, "Yes").first()
    assert row.shifted and abs(row.rate_change - 0.19) < 1e-12
    assert not metrics.rate_shift(before, before, "Yes").first().shifted


def test_gate(spark):
    df = spark.createDataFrame(
        [(1, 0.9, 0.9), (1, 0.8, 0.2), (0, 0.1, 0.1), (0, 0.3, 0.9)], "label int, good double, bad double"
    )
    better = gate.evaluate_gate(df, "label", "good", "bad")
    assert better.should_deploy and better.champion["f1"] == 0.5 and better.delta["f1"] == 0.5
    worse = gate.evaluate_gate(df, "label", "bad", "good")
    assert not worse.should_deploy and worse.reason.startswith("Gate FAILED. Challenger F1=0.5000 vs Champion F1=1.0000")
    with pytest.raises(ValueError, match="not promoted"):
        gate.require_passed(worse)
    assert gate.evaluate_gate(df, "label", "bad", "good", threshold=0.5).should_deploy  # bound included
    first = gate.evaluate_gate(df, "label", "bad", None)
    assert first.should_deploy and set(first.champion.values()) == {0.0}
    one_class = gate.evaluate_gate(df.where("label = 1"), "label", "good", "bad")
    assert one_class.challenger["roc_auc"] is None and one_class.delta["roc_auc"] is None


def test_search_feeds_training(spark):
    config = CONFIG.with_(cv_folds=2, models={"logistic_regression": {"C": [0.0001, 10.0], "class_weight": ["balanced"]}})
    rows = customers(spark, 200)
    best = models.best_settings(rows, config, "logistic_regression")
    (searched,) = models.train_all(rows, config, search=True)
    (first,) = models.train_all(rows, config)
    expected = 1 / (best["C"] * searched.metrics["n_train"])
    assert abs(searched.model.stages[-1].getRegParam() - expected) < 1e-12
    assert abs(first.model.stages[-1].getRegParam() - 1 / (0.0001 * first.metrics["n_train"])) < 1e-9
    forest = CONFIG.with_(cv_folds=2, models={"random_forest": {"n_estimators": [2, 3], "max_depth": [2, None]}, "gradient_boosted_trees": {"n_estimators": [2], "max_depth": [1, 2]}})
    assert [models.grid_search(rows, forest, m).count() for m in forest.models] == [4, 2]


def test_gate_counts_both_sides_in_one_pass(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(p):
        calls.add(1)
        return p

    scored = spark.range(400).select((F.col("id") % 2).cast("int").alias("label"), (F.col("id") / 400).alias("p")).withColumns(
        {"a": counted.asNondeterministic()("p"), "b": F.lit(0.7)}
    )
    found = gate.evaluate_gate(scored, "label", "a", "b")
    assert calls.value == 400 and set(found.challenger) == set(gate.GATE_METRICS)
