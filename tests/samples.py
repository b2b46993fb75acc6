"""Small customer tables in the shapes of FIXTURES.md."""

import random

from pyspark.sql import functions as F

from tidemark.config import from_mapping

# Columns and categories of the table that settings and models are made for
CATEGORICAL = [
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
]

# Names of the settings file; the numbers are free
SETTINGS = {
    "target_column": "Churn",
    "positive_class": "Yes",
    "id_column": "customerID",
    "feature_columns": {"numeric": ["tenure", "MonthlyCharges", "TotalCharges"], "categorical": CATEGORICAL},
    "training": {"fit_partitions": 1, "test_size": 0.20, "random_state": 42, "cv_folds": 3, "primary_metric": "f1"},
    "monitoring": {"granularities": ["1 day"], "drift_thresholds": {"psi": 0.20}, "accuracy_degradation_threshold": 0.05},
    "data_quality": {
        "tenure": {"min": 0, "max": 100},
        "MonthlyCharges": {"min": 0.0, "max": 500.0},
        "TotalCharges": {"min": 0.0, "max": 100000.0},
        "expected_churn_rate": {"min": 0.10, "max": 0.60},
    },
}

CONFIG = from_mapping(SETTINGS)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SCHEMA = (
    "customerID string, tenure int, MonthlyCharges double, TotalCharges double, SeniorCitizen int, "
    + ", ".join(f"{c} string" for c in CATEGORICAL if c != "SeniorCitizen")
    + ", Churn string"
)

YES_NO = ["Yes", "No"]
INTERNET_EXTRA = ["Yes", "No", "No internet service"]
# See above
VALUES = {
    "gender": ["Male", "Female"],
    "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    **{
        c: INTERNET_EXTRA
        for c in (
            "OnlineSecurity",
            "OnlineBackup",
            "DeviceProtection",
            "TechSupport",
            "StreamingTV",
            "StreamingMovies",
        )
    },
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaymentMethod": [
        "Electronic check",
        "Mailed check",
        "Bank transfer (automatic)",
        "Credit card (automatic)",
    ],
}


def customers(spark, n=100, seed=42):
    """Random customers whose tenure and contract tell something about churn."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tenure = rng.randrange(72)
        contract = rng.choice(VALUES["Contract"])
        risk = 0.7 - tenure / 120 - (0.25 if contract != "Month-to-month" else 0)
        row = {
            "customerID": f"C{i:04d}",
            "tenure": tenure,
            "MonthlyCharges": round(rng.uniform(5, 150), 2),
            "TotalCharges": round(rng.uniform(0, 9500), 2),
            "SeniorCitizen": rng.randrange(2),
            "Contract": contract,
            "Churn": "Yes" if rng.random() < risk else "No",
        }
        for c in CATEGORICAL:
            row.setdefault(c, rng.choice(VALUES.get(c, YES_NO)))
        rows.append(tuple(row[f.split()[0]] for f in SCHEMA.split(", ")))
    return spark.createDataFrame(rows, SCHEMA)


def five(spark):
    """Five customers, two of them positive, with values well inside the bounds."""
    df = customers(spark, 5)
    yes = F.when(F.col("customerID").isin("C0001", "C0003"), "Yes").otherwise("No")
    return df.withColumn("Churn", yes).withColumn("tenure", (F.col("tenure") % 45 + 1).cast("int"))
