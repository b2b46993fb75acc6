"""The encoder with a stored dictionary against the encoder that keeps its dictionaries."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from samples import CONFIG, customers
from tidemark.operators import wide_encoder
from tidemark.operators.features import FEATURES, TableEncoder, dummy_columns, feature_names, number_expression
from tidemark.operators.wide_encoder import WideEncoder, WideEncoderModel, build_dictionary, wide_names


def rows(spark):
    df = customers(spark, 120)
    return df.withColumn("Contract", F.when(F.col("tenure") > 5, F.col("Contract"))).withColumn("tenure", F.when(F.col("tenure") != 9, F.col("tenure")))


def vectors(df):
    return {r.customerID: r[FEATURES] for r in df.select("customerID", FEATURES).collect()}


def test_vectors_equal_those_of_the_table_encoder(spark, tmp_path, database):
    df, dense = rows(spark), TableEncoder(CONFIG).fit(rows(spark))
    unseen = df.withColumn("PaymentMethod", F.when(F.col("tenure") > 30, F.lit("barter")).otherwise(F.col("PaymentMethod")))
    for name in (str(tmp_path / "dictionary"), f"{database}.dictionary"):
        wide = WideEncoder(CONFIG, name).fit(df)
        assert [r.name for r in wide_names(spark, wide).orderBy("position").collect()] == feature_names(dense, CONFIG)
        found, wanted = vectors(wide.transform(unseen)), vectors(dense.transform(unseen))
        assert found.keys() == wanted.keys() and all(np.allclose(found[k].toArray(), wanted[k].toArray()) for k in wanted)
    with pytest.raises(Exception, match="already exists"):
        WideEncoder(CONFIG, str(tmp_path / "dictionary")).fit(df)


def test_a_saved_pipeline_names_the_dictionary(spark, tmp_path):
    df = rows(spark).withColumn("label", (F.col("Churn") == "Yes").cast("int"))
    wide = WideEncoder(CONFIG, str(tmp_path / "dictionary")).fit(df)
    fitted = PipelineModel([wide, LogisticRegression(maxIter=3).fit(wide.transform(df))])
    fitted.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert isinstance(loaded.stages[0], WideEncoderModel)
    scores = lambda m: {r.customerID: r.probability for r in m.transform(df).select("customerID", "probability").collect()}
    assert scores(loaded) == scores(fitted)


def test_positions_of_many_values_over_ranges(spark):
    df = spark.range(20_000).select((F.col("id") % 9_000).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("b"))
    found = [(r.ordinal, r.category, r.position) for r in build_dictionary(df, ["a", "b"], 3).collect()]
    texts = [sorted(str(i) for i in range(9_000)), sorted([*(str(i) for i in range(11)), "Unknown"])]
    wanted = [(i, t) for i, held in enumerate(texts) for t in held]
    assert sorted(found, key=lambda r: r[2]) == [(i, t, p) for p, (i, t) in enumerate(wanted, 3)]
    assert build_dictionary(df.limit(0), ["a"]).collect() == []


def test_dictionaries_of_the_driver_are_bounded(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    assert len(dummy_columns(df, ["c"]).columns) == 49
    with pytest.raises(ValueError, match="c has more than 20 values"):
        dummy_columns(df, ["c"], most=20)
    settings = CONFIG.with_(numeric=(), categorical=("c",), most_categories=20)
    with pytest.raises(ValueError, match="WideEncoder"):
        TableEncoder(settings).fit(df)


def test_number_columns_are_not_made_text(spark, tmp_path):
    """Numbers equal those of the way over text, in every type, and without it where the column holds numbers."""
    given = [0.1, -0.0, None, float("nan"), float("inf"), 5e-324, 1e300, 12345678.9]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(given)], "k string, d double")
    df = df.withColumns({"i": F.col("k").cast("int"), "l": F.col("k").cast("long") - (1 << 60), "s": F.concat(F.lit(" "), "k"), "f": F.lit(0.1).cast("float")})
    figures = {"d": (0.3, 0.7, 3.0), "i": (1.0, 2.5, 0.1), "l": (0.0, 1.0, 7.0), "s": (1.0, 2.0, 0.3), "f": (1.0, 2.0, 0.3)}
    new = [wide_encoder._number(df, c, *x).alias(c) for c, x in figures.items()]
    old = [F.expr(number_expression(c, *x)).alias(c) for c, x in figures.items()]
    assert repr(df.select(new).collect()) == repr(df.select(old).collect())
    plan = df.select(new[:3])._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan.lower() and "rlike" not in plan.lower()
