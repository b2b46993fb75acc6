import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from samples import CATEGORICAL, CONFIG, customers, five
from tidemark.functions import numeric
from tidemark.functions.numeric import to_number
from tidemark.operators import features


@pytest.fixture(scope="module")
def prepared(spark):
    return features.prepare(customers(spark, 60), CONFIG).cache()


@pytest.fixture(scope="module")
def encoder(prepared):
    return features.TableEncoder(CONFIG).fit(prepared)


def vectors(df):
    return [r.v for r in df.select(vector_to_array("features").alias("v")).collect()]


def test_prepare_drops_key_and_target_and_makes_a_label(spark):
    df = features.prepare(five(spark), CONFIG)
    assert "customerID" not in df.columns and "Churn" not in df.columns
    assert [r.label for r in features.prepare(five(spark), CONFIG, True).orderBy("customerID").collect()] == [0, 1, 0, 1, 0]
    assert dict(df.dtypes)["SeniorCitizen"] == "string"
    unlabelled = features.prepare(five(spark).drop("Churn"), CONFIG)
    assert "label" not in unlabelled.columns and "customerID" not in unlabelled.columns


def test_null_label_is_zero_and_null_category_stays_null(spark):
    df = five(spark).withColumn("Churn", F.lit(None).cast("string")).withColumn("SeniorCitizen", F.lit(None).cast("int"))
    rows = features.prepare(df, CONFIG).collect()
    assert {r.label for r in rows} == {0} and {r.SeniorCitizen for r in rows} == {None}


def test_shape_and_names(prepared, encoder):
    found = vectors(encoder.transform(prepared))
    names = features.feature_names(encoder, CONFIG)
    assert len(found) == 60 and {len(v) for v in found} == {len(names)}
    assert names[:3] == list(CONFIG.numeric) and "Contract=Month-to-month" in names
    assert not any(math.isnan(x) for v in found for x in v)


def test_numbers_are_centred_with_population_deviation(prepared, encoder):
    found = vectors(encoder.transform(prepared))
    for i in range(3):
        column = [v[i] for v in found]
        assert abs(sum(column)) < 1e-6
        assert abs(sum(x * x for x in column) / len(column) - 1) < 1e-9


def test_every_category_has_one_hot_and_unseen_has_none(prepared, encoder):
    names = features.feature_names(encoder, CONFIG)
    slots = [i for i, n in enumerate(names) if n.startswith("Contract=")]
    assert all(sum(v[i] for i in slots) == 1 for v in vectors(encoder.transform(prepared)))
    odd = vectors(encoder.transform(prepared.limit(1).withColumn("Contract", F.lit("Five year"))))[0]
    assert all(odd[i] == 0 for i in slots)


def test_missing_values(spark):
    df = five(spark).withColumn("TotalCharges", F.when(F.col("customerID") != "C0000", F.col("TotalCharges")))
    df = df.withColumn("Contract", F.when(F.col("customerID") != "C0002", F.col("Contract")))
    rows = features.prepare(df, CONFIG, keep_key=True)
    model = features.TableEncoder(CONFIG).fit(rows)
    assert "Contract=Unknown" in features.feature_names(model, CONFIG)
    found = {r.customerID: r for r in features.encoded_columns(rows, model, CONFIG, "customerID").collect()}
    known = sorted(r.TotalCharges for r in rows.where("TotalCharges is not null").collect())
    median = (known[1] + known[2]) / 2
    filled = known + [median]
    mean = sum(filled) / 5
    std = math.sqrt(sum((x - mean) ** 2 for x in filled) / 5)
    assert abs(found["C0000"]["TotalCharges"] - (median - mean) / std) < 1e-9


def test_constant_and_empty_columns(spark):
    df = five(spark).withColumn("tenure", F.lit(7)).withColumn("TotalCharges", F.lit(None).cast("double"))
    rows = features.prepare(df, CONFIG)
    found = vectors(features.TableEncoder(CONFIG).fit(rows).transform(rows))
    assert all(v[0] == 0 and v[2] == 0 for v in found)


def test_saved_encoder_gives_the_same(prepared, encoder, tmp_path):
    encoder.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert vectors(again.transform(prepared)) == vectors(encoder.transform(prepared))


def test_a_dictionary_of_any_size_is_a_table(spark):
    rows = spark.range(12_000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id"))).alias("c"))
    wanted = sorted({r.c if r.c is not None else "Unknown" for r in rows.collect()})
    positions = features.category_positions(rows, "c")
    assert [r.category for r in positions.orderBy("position").collect()] == wanted
    assert sorted(r.position for r in positions.collect()) == list(range(len(wanted)))
    unseen = features.positions_of(spark.createDataFrame([("nowhere",), (None,)], "c string"), "c", positions)
    assert {r.c: r.position for r in unseen.collect()} == {"nowhere": None, None: wanted.index("Unknown")}


def test_fit_and_apply_read_numbers_alike(spark):
    texts = ["12", " 3.5 ", "12d", "3F", "", "x", None, "NaN", "1e3", "-7"]
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    read = [r[0] for r in df.select(to_number(df, "n")).collect()]
    used = [r[0] for r in df.selectExpr(features.number_expression("n", 1000000.0, 0.0, 1.0)).collect()]
    assert used == [1000000.0 if v is None else v for v in read] and read.count(None) == 6


def test_new_rows_win_as_a_whole(spark):
    base = spark.createDataFrame([(k, k, "old") for k in range(100)] + [(5, 1, "old"), (None, 0, "old")], "k int, x int, y string")
    new = spark.createDataFrame([(k, -k, "new") for k in range(50, 150)] + [(50, 7, "new")], "k int, x int, y string")
    found = [features.combine_newest(b, n, "k").orderBy("k").collect() for b, n in ((base, new), (base.repartition(7), new.repartition(3)))]
    assert found[0] == found[1] and len(found[0]) == 151
    assert all((r.y == "new") == (r.k is not None and r.k >= 50) for r in found[0])
    assert all(r.x in (-r.k, 7) for r in found[0] if r.y == "new")


def test_columns_not_configured_are_ignored(prepared, encoder):
    more = prepared.withColumn("note", F.lit("x"))
    assert vectors(encoder.transform(more)) == vectors(encoder.transform(prepared))


def test_dummy_columns_leave_the_first_out(spark):
    df = five(spark).select("customerID", "gender").withColumn("gender", F.when(F.col("customerID") != "C0000", F.col("gender")))
    both = df.unionByName(df.withColumn("gender", F.lit("Other")))
    found = features.dummy_columns(both, ["gender"])
    assert found.columns == ["customerID", "gender_Male", "gender_Other"]
    assert found.where("customerID = 'C0000'").agg(F.sum("gender_Male")).first()[0] == 0


def test_dedupe_keeps_the_newest_and_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("seen"))
    newest = features.dedupe(df, ["k"], [F.desc("seen")])
    assert sorted(tuple(r) for r in newest.collect()) == [(0, 99), (1, 97), (2, 98)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_coercion(spark):
    texts = [" 12.5 ", "", "  ", "x", "nan", "5d", "7F", "1e3", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(numeric.to_number(df, "t")).collect()]
    assert found == [12.5, None, None, None, None, None, None, 1000.0, None]


def test_config_lists(spark):
    assert len(CATEGORICAL) == 16 and CONFIG.as_string == ("SeniorCitizen",)
    assert CONFIG.rate_bounds == (0.10, 0.60) and CONFIG.ranges["tenure"] == (0, 100)
