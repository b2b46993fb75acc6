"""The three classifiers: choose by name, fit, compare, search their grids."""

from __future__ import annotations

import itertools
import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.operators import metrics as quality
from tidemark.operators.features import FEATURES, LABEL, TableEncoder, prepare
from tidemark.operators.split import fold_column, mark_share
from tidemark.session import cut_lineage
from tidemark.sources import registry, run_log

MODEL_TYPES = ("logistic_regression", "random_forest", "gradient_boosted_trees")
SEARCH_THREADS = 4
MAX_TREE_DEPTH = 30  # the deepest tree Spark grows; stands for "no limit"
#: Fitting tasks of `fit_rows` rows each; a table with rows for more of them gets more tasks and fuller ones.
FULL_TASKS = 16
_WEIGHT = "_weight"


@dataclass
class TrainResult:
    run_id: str
    model_type: str
    batch_id: str
    metrics: dict[str, float | None]
    model: PipelineModel
    report: list[tuple] = field(default_factory=list)
    model_path: str = ""


def first_values(grid: dict[str, list]) -> dict[str, object]:
    """The first element of every hyper-parameter list."""
    return {name: (v[0] if isinstance(v, (list, tuple)) else v) for name, v in grid.items()}


def grid_points(grid: dict[str, list]) -> list[dict[str, object]]:
    lists = [v if isinstance(v, (list, tuple)) else [v] for v in grid.values()]
    return [dict(zip(grid, values)) for values in itertools.product(*lists)]


class TableClassifier(Estimator):
    """A classifier by name on `features` and `label`, with class weights and penalty set from the data."""

    def __init__(self, model_type: str, hyper: dict[str, object] | None = None, seed: int = 42):
        super().__init__()
        if model_type not in MODEL_TYPES:
            raise ValueError(f"No classifier is called {model_type!r}; there are {', '.join(MODEL_TYPES)}")
        self.model_type, self.hyper, self.seed = model_type, dict(hyper or {}), seed

    def inner(self, n_rows: int) -> Estimator:
        """The Spark estimator for a training set of `n_rows` rows."""
        h = self.hyper
        common = {"featuresCol": FEATURES, "labelCol": LABEL}
        if self.model_type == "logistic_regression":
            # Spark minimises the mean loss, the setting C weighs the summed loss; weights sum to n_rows
            return LogisticRegression(
                **common,
                regParam=1.0 / (float(h.get("C", 1.0)) * max(n_rows, 1)),
                elasticNetParam=0.0,
                standardization=False,
                maxIter=int(h.get("max_iter", 200)),
            )
        if self.model_type == "random_forest":
            depth = h.get("max_depth", 10)
            return RandomForestClassifier(
                **common,
                numTrees=int(h.get("n_estimators", 100)),
                maxDepth=MAX_TREE_DEPTH if depth is None else int(depth),
                minInstancesPerNode=int(h.get("min_samples_leaf", 1)),
                featureSubsetStrategy="sqrt",
                seed=self.seed,
            )
        return GBTClassifier(
            **common,
            maxIter=int(h.get("n_estimators", 100)),
            stepSize=float(h.get("learning_rate", 0.1)),
            maxDepth=int(h.get("max_depth", 3)),
            subsamplingRate=float(h.get("subsample", 1.0)),
            seed=self.seed,
        )

    def _balanced(self) -> bool:
        if self.model_type == "gradient_boosted_trees":
            return False
        return self.hyper.get("class_weight", "balanced") == "balanced"

    def _fit(self, dataset: DataFrame) -> Model:
        counts = {r[LABEL]: r.n for r in dataset.groupBy(LABEL).agg(F.count("*").alias("n")).collect()}
        n_rows = sum(counts.values())
        estimator = self.inner(n_rows)
        if self._balanced():
            weight = F.lit(1.0)
            for label, n in counts.items():
                weight = F.when(F.col(LABEL) == label, F.lit(n_rows / (len(counts) * n))).otherwise(weight)
            dataset = dataset.withColumn(_WEIGHT, weight)
            estimator = estimator.setWeightCol(_WEIGHT)
        return estimator.fit(dataset)


def make_classifier(model_type: str, config: Config, hyper: dict[str, object] | None = None) -> TableClassifier:
    """The classifier of that name with the first value of each configured list."""
    chosen = hyper if hyper is not None else first_values(config.models.get(model_type, {}))
    return TableClassifier(model_type, chosen, config.seed)


def score(df: DataFrame, model: Model) -> DataFrame:
    """`df` with the class 0/1 as `predicted` and the probability of the positive class as `prob`."""
    kept = [c for c in df.columns if c != FEATURES]
    return model.transform(df).select(
        *kept, F.col("prediction").cast("int").alias("predicted"), vector_to_array("probability")[1].alias("prob")
    )


def _keep(df: DataFrame) -> DataFrame:
    # a lost executor's blocks are computed again from the table: split and encoding are repeatable
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def fitting_tasks(df: DataFrame, config: Config) -> int | None:
    """Tasks that a fit on these rows gets at most: the number named, or as many as hold `fit_rows` rows each.

    Every task of every level of every tree answers the driver, so from `FULL_TASKS` on their number grows with the
    square root of the rows, and so do the rows of a task. So the number follows the table and not the cluster, and a
    fit can be repeated elsewhere. None leaves it to Spark.
    """
    if config.fit_partitions or not config.fit_rows:
        return config.fit_partitions
    tasks = max(1, -(-df.count() // config.fit_rows))
    return tasks if tasks <= FULL_TASKS else math.isqrt(FULL_TASKS * tasks - 1) + 1


def _for_fitting(df: DataFrame, tasks: int | None) -> DataFrame:
    """The rows in at most so many partitions, merged without a shuffle, and stored.

    Forest and boosting draw their samples per partition, so the number belongs to the fit and is logged with it. Stored
    rows have no plan behind them: every task of every level would send the driver the metrics of all steps of the plan.
    """
    return cut_lineage(df.coalesce(tasks) if tasks else df)


def _training_columns(df: DataFrame, config: Config) -> DataFrame:
    """Key, features and label; the fit passes over them several times, so they are kept."""
    prepared = prepare(df, config, keep_key=True)
    if LABEL not in prepared.columns:
        raise ValueError(f"The training data has no target column {config.target}")
    return _keep(prepared.select(config.key, *config.features, LABEL))


class TrainingSet:
    """Split, encoded and cached once, and then used by every classifier."""

    def __init__(self, data: DataFrame, config: Config):
        self.config = config
        rows = _training_columns(data, config)
        try:
            marked = mark_share(rows, config.key, config.test_size, config.seed, F.col(LABEL))
            self.encoder = TableEncoder(config).fit(marked.where(~F.col("is_test")))
            self.encoded = _keep(self.encoder.transform(marked).select(FEATURES, LABEL, "is_test"))
            train = self.encoded.where(~F.col("is_test"))
            self.fitting_tasks = fitting_tasks(train, config)
            self.train = _for_fitting(train, self.fitting_tasks)
        finally:
            rows.unpersist()

    def fit(self, model_type: str, hyper: dict[str, object] | None = None) -> Model:
        return make_classifier(model_type, self.config, hyper).fit(self.train)

    def evaluate(self, model: Model) -> tuple[dict[str, float | None], list[tuple]]:
        """Test metrics, training F1 and row counts, and the class report of the test rows."""
        scored = _keep(score(self.encoded, model))
        try:
            label, predicted = F.col(LABEL), F.col("predicted")
            sides = {
                r.is_test: r for r in quality.confusion_metrics(scored, label, predicted, ("is_test",)).collect()
            }
            test, train = sides.get(True), sides.get(False)
            on_test = scored.where("is_test")
            found = {f"test_{m}": (test[m] if test else 0.0) for m in quality.METRICS}
            found["test_roc_auc"] = quality.roc_auc(on_test, LABEL, "prob")
            found["train_f1"] = train["f1"] if train else 0.0
            for name, side in (("n_train", train), ("n_test", test)):
                found[name] = float(sum(side[c] for c in ("tp", "fp", "fn", "tn"))) if side else 0.0
            names = (f"not {self.config.target}", self.config.target)
            report = [tuple(r) for r in quality.class_report(on_test, label, predicted, names).collect()]
        finally:
            scored.unpersist()
        return found, report

    def close(self) -> None:
        self.encoded.unpersist()


def train_model(
    data: TrainingSet,
    model_type: str,
    batch_id: str,
    prefix: str | None = None,
    model_root: str | None = None,
    hyper: dict[str, object] | None = None,
) -> TrainResult:
    """Fit one classifier, measure it, and log and save it when a log prefix and model folder are given."""
    started = datetime.now(timezone.utc)
    classifier = make_classifier(model_type, data.config, hyper)
    fitted = classifier.fit(data.train)
    found, report = data.evaluate(fitted)
    pipeline = PipelineModel([*data.encoder.stages, fitted])
    result = TrainResult(uuid.uuid4().hex, model_type, batch_id, found, pipeline, report)
    if prefix and model_root:
        result.model_path = registry.save_model(pipeline, f"{model_root.rstrip('/')}/{result.run_id}")
        params = {
            "model_type": model_type,
            "test_size": data.config.test_size,
            "random_state": data.config.seed,
            "fit_partitions": data.fitting_tasks,
            # a depth without limit is fitted with the deepest there is
            **{f"clf_{k}": MAX_TREE_DEPTH if k == "max_depth" and v is None else v for k, v in classifier.hyper.items()},
        }
        run_log.log_run(
            data.encoded.sparkSession,
            prefix,
            result.run_id,
            batch_id,
            model_type,
            started,
            result.model_path,
            params,
            found,
            report,
        )
    return result


def train_all(
    df: DataFrame,
    config: Config,
    batch_id: str | None = None,
    prefix: str | None = None,
    model_root: str | None = None,
    search: bool = False,
) -> list[TrainResult]:
    """Every configured classifier, in the order of the settings, on one cached training set.

    With `search`, each is fitted with the point of its grid that does best in cross-validation, else with the first.
    """
    chosen = {name: best_settings(df, config, name) if search else None for name in config.models}
    data = TrainingSet(df, config)
    batch = batch_id or uuid.uuid4().hex
    try:
        return [train_model(data, name, batch, prefix, model_root, chosen[name]) for name in config.models]
    finally:
        data.close()


def _fold_metric(scored: DataFrame, metric: str) -> float | None:
    if metric == "roc_auc":
        return quality.roc_auc(scored, LABEL, "prob")
    return quality.confusion_metrics(scored, F.col(LABEL), F.col("predicted")).first()[metric]


def grid_search(df: DataFrame, config: Config, model_type: str) -> DataFrame:
    """Cross-validated metric for every point of a classifier's grid, the best first.

    The encoder is fitted once per fold, on that fold's training rows only, and serves all grid points.
    """
    spark = df.sparkSession
    points = grid_points(config.models[model_type])
    rows = _training_columns(df, config)
    found: list[tuple[int, int, float | None]] = []
    try:
        folded = rows.withColumn("fold", fold_column(config.key, config.seed, config.cv_folds))
        for fold in range(config.cv_folds):
            held: Column = F.col("fold") == fold
            encoder = TableEncoder(config).fit(folded.where(~held))
            encoded = _keep(encoder.transform(folded).select(FEATURES, LABEL, "fold"))
            try:
                train = _for_fitting(encoded.where(~held), fitting_tasks(encoded.where(~held), config))

                def measure(i: int, train: DataFrame = train, encoded: DataFrame = encoded, held: Column = held) -> float | None:
                    fitted = make_classifier(model_type, config, points[i]).fit(train)
                    return _fold_metric(score(encoded.where(held), fitted), config.primary_metric)

                # the jobs of the points of a fold interleave, so that small ones do not wait for each other
                with ThreadPoolExecutor(max_workers=SEARCH_THREADS) as pool:
                    found += [(i, fold, value) for i, value in enumerate(pool.map(measure, range(len(points))))]
            finally:
                encoded.unpersist()
    finally:
        rows.unpersist()
    measured = spark.createDataFrame(found, "point int, fold int, value double")
    described = spark.createDataFrame(
        [(i, ", ".join(f"{k}={v}" for k, v in p.items())) for i, p in enumerate(points)], "point int, settings string"
    )
    return (
        measured.groupBy("point")
        .agg(F.avg("value").alias("mean_metric"), F.stddev_pop("value").alias("std_metric"))
        .join(described, "point")
        .select(F.lit(model_type).alias("model_type"), "settings", "mean_metric", "std_metric")
        .orderBy(F.desc_nulls_last("mean_metric"), "settings")
    )


def best_settings(df: DataFrame, config: Config, model_type: str) -> dict[str, object]:
    """The grid point with the best cross-validated metric."""
    best = grid_search(df, config, model_type).first()
    for point in grid_points(config.models[model_type]):
        if ", ".join(f"{k}={v}" for k, v in point.items()) == best.settings:
            return point
    raise AssertionError("the best settings come from the grid")
