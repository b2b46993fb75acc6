"""Settings of one modelling project: columns, split, model grids, checks, alerts."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

# Default hyper-parameter lists. Only the first element of a list
# is used for training; the whole lists are used by the grid search.
DEFAULT_MODELS: dict[str, dict[str, list]] = {
    "logistic_regression": {
        "C": [0.01, 0.1, 1.0],
        "max_iter": [200],
        "class_weight": ["balanced"],
    },
    "random_forest": {
        "n_estimators": [100, 200],
        "max_depth": [5, 10, None],
        "min_samples_leaf": [1, 5],
        "class_weight": ["balanced"],
    },
    "gradient_boosted_trees": {
        "n_estimators": [100, 200],
        "learning_rate": [0.05, 0.1],
        "max_depth": [3, 5],
        "subsample": [0.8, 1.0],
    },
}

# Bounds of the positive rate when the settings name none.
DEFAULT_RATE_BOUNDS = (0.05, 0.70)


@dataclass(frozen=True)
class Config:
    """Everything the operators need to know about a keyed, labelled table."""

    key: str
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    positive: str = "Yes"
    negative: str = "No"
    as_string: tuple[str, ...] = ()
    test_size: float = 0.20
    seed: int = 42
    cv_folds: int = 3
    primary_metric: str = "f1"
    models: dict[str, dict[str, list]] = field(default_factory=lambda: dict(DEFAULT_MODELS))
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    rate_bounds: tuple[float, float] = DEFAULT_RATE_BOUNDS
    null_rate_columns: tuple[str, ...] = ("tenure", "MonthlyCharges")
    null_rate_limit: float = 0.05
    gate_threshold: float = 0.05
    psi_threshold: float = 0.20
    f1_drop_threshold: float = 0.05
    granularity: str = "1 day"
    model_name: str = "classifier"
    log_suffix: str = "inference_log"
    baseline_table: str | None = None
    fit_partitions: int | None = None
    #: Rows that a fitting task should have at least, where `fit_partitions` names no number of tasks.
    fit_rows: int | None = None
    #: Categories of a column that an encoder may bring to the driver.
    most_categories: int = 100_000

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def with_(self, **changes: Any) -> "Config":
        return replace(self, **changes)


def from_mapping(raw: dict[str, Any], **overrides: Any) -> Config:
    """Build a Config from the nested layout used in project YAML files."""
    training = raw.get("training", {})
    monitoring = raw.get("monitoring", {})
    quality = dict(raw.get("data_quality", {}))
    rate = quality.pop("expected_churn_rate", None) or quality.pop("expected_positive_rate", None)
    settings: dict[str, Any] = {
        "key": raw.get("id_column", "customerID"),
        "target": raw.get("target_column", "Churn"),
        "positive": raw.get("positive_class", "Yes"),
        "numeric": tuple(raw["feature_columns"]["numeric"]),
        "categorical": tuple(raw["feature_columns"]["categorical"]),
        "as_string": tuple(raw.get("as_string", ["SeniorCitizen"])),
        "test_size": training.get("test_size", 0.20),
        "seed": training.get("random_state", 42),
        "cv_folds": training.get("cv_folds", 3),
        "primary_metric": training.get("primary_metric", "f1"),
        "models": raw.get("models", dict(DEFAULT_MODELS)),
        "ranges": {
            name: (bounds["min"], bounds["max"])
            for name, bounds in quality.items()
            if isinstance(bounds, dict) and "min" in bounds and "max" in bounds
        },
        "rate_bounds": (rate["min"], rate["max"]) if rate else DEFAULT_RATE_BOUNDS,
        "psi_threshold": monitoring.get("drift_thresholds", {}).get("psi", 0.20),
        "f1_drop_threshold": monitoring.get("accuracy_degradation_threshold", 0.05),
        "granularity": (monitoring.get("granularities") or ["1 day"])[0],
        "model_name": raw.get("model_name", "classifier"),
        "log_suffix": monitoring.get("inference_table_suffix", "inference_log"),
        "baseline_table": monitoring.get("baseline_table"),
        "fit_partitions": training.get("fit_partitions"),
        "fit_rows": training.get("fit_rows"),
    }
    return Config(**{**settings, **overrides})


def load(path: str, **overrides: Any) -> Config:
    """Read a project YAML file."""
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - yaml is optional
        raise RuntimeError("Reading a settings file needs the yaml package") from error
    with open(path) as handle:
        return from_mapping(yaml.safe_load(handle), **overrides)
