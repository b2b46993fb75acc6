import hashlib
import math

from pyspark.sql import functions as F

from tidemark.operators import split
from tidemark.operators.quantiles import exact_quantiles


def brute(keys, share, seed):
    drawn = set()
    groups = {}
    for key, label in keys:
        groups.setdefault(label, []).append(key)
    quotas = split.quotas({label: len(k) for label, k in groups.items()}, share)
    for label, members in groups.items():
        members.sort(key=lambda k: hashlib.md5(f"{k}{seed}".encode()).hexdigest())
        drawn |= set(members[: quotas[label]])
    return drawn


def test_quotas_by_largest_remainder():
    assert split.quotas({0: 58, 1: 341}, 0.2) == {0: 12, 1: 68}
    assert split.quotas({0: 3, 1: 3}, 0.5) == {0: 2, 1: 1}
    assert split.quotas({0: 5}, 0.0) == {0: 0}


def test_split_is_exact_and_the_same_for_any_partitioning(spark):
    df = spark.range(1003).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    wanted = brute([(i, int(i % 7 == 0)) for i in range(1003)], 0.2, 42)
    for parts in (1, 5):
        train, test = split.train_test_split(df.repartition(parts), "id", 0.2, 42, F.col("label"))
        assert {r.id for r in test.collect()} == wanted
        assert train.count() + test.count() == 1003
    assert len(wanted) == math.ceil(0.2 * 1003)


def test_copies_of_a_hot_key_stay_together(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("k"))
    marked = split.mark_share(df, "k", 0.5, 1)
    sides = {r.is_test for r in marked.where("k = -1").select("is_test").distinct().collect()}
    assert len(sides) == 1
    assert abs(marked.where("is_test").count() - 450) <= 300


def test_the_rows_do_not_move(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("label"))
    plan = split.mark_share(df, "id", 0.2, 42, F.col("label"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_extreme_shares(spark):
    df = spark.range(50)
    assert split.mark_share(df, "id", 0.0, 1).where("is_test").count() == 0
    assert split.mark_share(df, "id", 1.0, 1).where("is_test").count() == 50
    assert split.mark_share(df.limit(0), "id", 0.2, 1).count() == 0


def test_folds_are_fixed_and_cover_all(spark):
    df = spark.range(600).withColumn("f", split.fold_column("id", 42, 3))
    sizes = {r.f: r["count"] for r in df.groupBy("f").count().collect()}
    assert set(sizes) == {0, 1, 2} and min(sizes.values()) > 150
    again = spark.range(600).repartition(7).withColumn("f", split.fold_column("id", 42, 3))
    assert df.exceptAll(again).count() == 0


def test_quantiles_equal_the_built_in_ones(spark):
    skewed = (
        spark.range(4000)
        .select(
            F.when(F.col("id") < 2500, "hot").when(F.col("id") % 4 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
            F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pow(F.rand(1) * 10, 5)).alias("v"),
        )
        .withColumn("v", F.when(F.col("v") < 9e4, F.col("v")))
    ).cache()
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    direct = {r.g: r.q for r in skewed.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("q")).collect()}
    for parts in (2, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = {r.g: r.quantiles for r in exact_quantiles(skewed, ["g"], "v", probs).collect()}
        assert set(direct) == set(found) == {"hot", "g0", "g1", "g2", None}
        for g in direct:
            assert all(abs(a - b) <= 1e-9 * max(1, abs(a)) for a, b in zip(direct[g], found[g])), g
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_quantiles_of_one_repeated_value_and_of_none(spark):
    df = spark.range(500).select(F.lit("a").alias("g"), F.lit(3.5).alias("v"))
    assert exact_quantiles(df, ["g"], "v", [0.1, 0.5]).first().quantiles == [3.5, 3.5]
    assert exact_quantiles(df.withColumn("v", F.lit(None)), ["g"], "v", [0.5]).collect() == []


def test_a_large_cut_prefix_is_narrowed_down(spark, monkeypatch):
    rows = spark.range(3000).select("id", (F.col("id") % 3).alias("s"))
    direct = split.mark_share(rows, "id", 0.3, 1, F.col("s")).collect()
    monkeypatch.setattr(split, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(split, "ONE_TASK", 2)
    assert sorted(split.mark_share(rows, "id", 0.3, 1, F.col("s")).collect()) == sorted(direct)
