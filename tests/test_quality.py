import pytest
from pyspark.sql import functions as F

from samples import CONFIG, five
from tidemark.operators import quality


def report(df, config=CONFIG):
    return {r.check_name: r for r in quality.check_input(df, config).collect()}


def test_clean_table_passes_in_order(spark):
    rows = quality.check_input(five(spark), CONFIG)
    assert rows.columns == ["check_name", "passed", "actual_value", "details"]
    assert [r.check_name for r in rows.collect()] == [
        "row_count_positive",
        "required_columns_present",
        "tenure_in_range",
        "MonthlyCharges_in_range",
        "TotalCharges_in_range",
        "positive_rate_in_range",
        "tenure_null_rate_low",
        "MonthlyCharges_null_rate_low",
    ]
    assert all(r.passed for r in rows.collect())
    quality.require_passed(rows)
    assert report(five(spark))["positive_rate_in_range"].actual_value == "40.0%"


def test_negative_tenure_fails(spark):
    found = report(five(spark).withColumn("tenure", F.lit(-1)))
    assert not found["tenure_in_range"].passed
    assert found["tenure_in_range"].actual_value == "[-1.00, -1.00]"
    with pytest.raises(ValueError, match="tenure_in_range"):
        quality.require_passed(quality.check_input(five(spark).withColumn("tenure", F.lit(-1)), CONFIG))


def test_missing_column_fails_once_and_its_checks_are_absent(spark):
    found = report(five(spark).drop("MonthlyCharges"))
    assert not found["required_columns_present"].passed
    assert found["required_columns_present"].details == "Missing: ['MonthlyCharges']"
    assert "MonthlyCharges_in_range" not in found
    assert "MonthlyCharges_null_rate_low" not in found


def test_only_positives_fail(spark):
    assert not report(five(spark).withColumn("Churn", F.lit("Yes")))["positive_rate_in_range"].passed


def test_bounds_are_inclusive_and_null_rate_is_strict(spark):
    config = CONFIG.with_(rate_bounds=(0.4, 0.4), ranges={"v": (1, 3)}, null_rate_columns=("v",), null_rate_limit=0.2)
    df = five(spark).withColumn("n", F.row_number().over(__import__("pyspark").sql.Window.orderBy("customerID")))
    df = df.withColumn("v", F.when(F.col("n") > 1, (F.col("n") % 3 + 1).cast("string")).otherwise("bad"))
    found = report(df, config)
    assert found["positive_rate_in_range"].passed
    assert found["v_in_range"].passed and found["v_in_range"].actual_value == "[1.00, 3.00]"
    nulls = report(df.withColumn("v", F.when(F.col("n") > 1, F.lit(1.0))), config)
    assert not nulls["v_null_rate_low"].passed and nulls["v_null_rate_low"].actual_value == "20.0%"


def test_column_without_numbers_passes_its_range(spark):
    found = report(five(spark).withColumn("TotalCharges", F.lit("")))
    assert found["TotalCharges_in_range"].passed
    assert found["TotalCharges_in_range"].actual_value == "[nan, nan]"


def test_nan_is_no_number(spark):
    df = five(spark).withColumn("MonthlyCharges", F.lit(float("nan")))
    found = report(df)
    assert found["MonthlyCharges_in_range"].actual_value == "[nan, nan]"
    assert not found["MonthlyCharges_null_rate_low"].passed


def test_empty_table_fails_counts_and_rates(spark):
    found = report(five(spark).limit(0))
    assert not found["row_count_positive"].passed
    assert not found["positive_rate_in_range"].passed
    assert found["positive_rate_in_range"].actual_value == "nan%"
    assert not found["tenure_null_rate_low"].passed
    assert found["tenure_in_range"].passed


def test_null_label_counts_as_negative(spark):
    df = five(spark).withColumn("Churn", F.when(F.col("Churn") == "Yes", "Yes"))
    assert report(df)["positive_rate_in_range"].actual_value == "40.0%"


def test_one_job_reads_only_checked_columns(spark, tmp_path):
    five(spark).write.parquet(str(tmp_path / "t"))
    plan = quality.check_input(spark.read.parquet(str(tmp_path / "t")), CONFIG)._jdf.queryExecution().toString()
    assert plan.count("FileScan") == 1
    assert "gender" not in plan.split("ReadSchema")[-1]


SCORED = "prediction string, prediction_prob double, model_id string, inference_ts string"


def scored(spark, *rows):
    return spark.createDataFrame(list(rows), SCORED)


def test_scored_table_checks(spark):
    ts = "2026-05-07T09:00:00"
    good = scored(spark, ("No", 0.12, "m_v1", ts), ("No", 0.5, "m_v1", ts), ("Yes", 0.81, "m_v1", ts))
    assert quality.failed_checks(quality.check_scored(good, CONFIG)).count() == 0
    bad = scored(spark, ("No", 0.9, "", ts), ("Yes", 0.1, None, None), ("Maybe", 1.5, "m", ts), (None, None, "m", ts))
    found = {r.check_name: r.actual_value for r in quality.check_scored(bad, CONFIG).collect()}
    assert found == {
        "required_columns_present": "[]",
        "prediction_valid": "2",
        "prediction_prob_in_range": "2",
        "model_id_present": "2",
        "inference_ts_present": "1",
        "high_prob_is_positive": "2",
        "low_prob_is_negative": "1",
    }
    missing = {r.check_name: r for r in quality.check_scored(good.drop("model_id"), CONFIG).collect()}
    assert not missing["required_columns_present"].passed and "model_id_present" not in missing


def test_summary(spark):
    row = quality.summarise_checks(quality.check_input(five(spark).drop("gender"), CONFIG)).first()
    assert (row.n_passed, row.n_checks) == (7, 8)


def test_failed_range_from_negative_zero_reads_as_sql_writes_it(spark):
    low = F.when(F.col("tenure") == five(spark).agg(F.min("tenure")).first()[0], F.lit(-0.0)).otherwise(F.lit(9e6))
    found = quality.failed_checks(quality.check_input(five(spark).withColumn("MonthlyCharges", low), CONFIG)).collect()
    assert [(r.check_name, r.actual_value) for r in found] == [("MonthlyCharges_in_range", "[0.00, 9000000.00]")]


def test_report_writes_a_range_of_zeros_without_sign(spark):
    found = report(five(spark).withColumn("MonthlyCharges", F.lit(-0.0)))
    assert found["MonthlyCharges_in_range"].actual_value == "[0.00, 0.00]"
