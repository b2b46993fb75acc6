import threading
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samples import CONFIG, SCHEMA, SETTINGS, customers
from tidemark import session
from tidemark.config import load
from tidemark.sources import feature_table, records, registry, run_log, scored_log
from tidemark.sources.registry import AliasNotFound, Registry
from tidemark.sources.tables import find_tables, load_csv, load_csv_table, read_table, use_database, user_database


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_by_name_path_and_override(spark, database, tmp_path):
    spark.range(3).write.saveAsTable(f"{database}.t")
    spark.range(5).write.parquet(str(tmp_path / "p"))
    assert read_table(spark, f"{database}.t").count() == 3
    assert read_table(spark, f"{database}.t", str(tmp_path / "p")).count() == 5


def test_csv_with_blank_numbers(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("id,charges,plan\n1,12.5,a\n2, ,b\n3,,c\n")
    schema = T.StructType.fromDDL("id int, charges double, plan string")
    found = load_csv(spark, str(path), schema, ["charges"])
    assert found.schema.simpleString() == schema.simpleString()
    assert [r.charges for r in found.orderBy("id").collect()] == [12.5, None, None]


def test_settings_file(tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yml").write_text(yaml.safe_dump(SETTINGS))
    assert load(str(tmp_path / "c.yml")) == CONFIG


def test_databases_and_discovery(spark, database):
    other = f"{database}_b"
    before = spark.catalog.currentDatabase()
    use_database(spark, other, session.scratch_path(spark, other))
    assert spark.catalog.currentDatabase() == other
    spark.catalog.setCurrentDatabase(before)
    name = f"log_{database}"
    for db in (database, other):
        spark.range(1).write.saveAsTable(f"{db}.{name}")
    spark.range(1).write.saveAsTable(f"{other}.{name}_2")
    found, failed = find_tables(spark, name)
    assert set(found) == {f"`{database}`.`{name}`", f"`{other}`.`{name}`"} and failed == []
    spark.conf.set("spark.sql.catalog.gone", "no.such.Catalog")
    try:
        still, failed = find_tables(spark, name)
    finally:
        spark.conf.unset("spark.sql.catalog.gone")
    assert still == found and [place for place, _ in failed] == ["gone"]
    spark.sql(f"DROP DATABASE {other} CASCADE")
    assert user_database(spark)


def test_feature_table_life(spark, database):
    name = f"{database}.features"
    rows = customers(spark, 20).select("customerID", "tenure")
    assert feature_table.write(rows, name, "customerID", buckets=4) == 20
    with pytest.raises(ValueError, match="already exists"):
        feature_table.create(rows, name, "customerID")
    changed = rows.limit(5).withColumn("tenure", F.lit(-5)).unionByName(
        spark.createDataFrame([("new", 1)], "customerID string, tenure int")
    )
    assert feature_table.write(changed, name, "customerID", buckets=4) == 21
    found = spark.table(name)
    assert found.where("tenure = -5").count() == 5 and found.where("customerID = 'new'").count() == 1
    assert found.exceptAll(changed).count() == 15


def test_feature_table_refuses_bad_keys_and_keeps_the_old_version(spark, database):
    name = f"{database}.features"
    rows = customers(spark, 10).select("customerID", "tenure")
    feature_table.write(rows, name, "customerID")
    twice = rows.unionByName(rows)
    with pytest.raises(feature_table.KeyViolation, match="10 repeated keys"):
        feature_table.merge(twice, name, "customerID")
    with pytest.raises(feature_table.KeyViolation, match="1 rows without key"):
        feature_table.merge(rows.limit(1).withColumn("customerID", F.lit(None).cast("string")), name, "customerID")
    assert spark.table(name).count() == 10


def test_bucketed_features_are_not_shuffled(spark, database):
    name = f"{database}.features"
    feature_table.create(customers(spark, 50).select("customerID", "tenure"), name, "customerID", buckets=4)
    labels = customers(spark, 50).select("customerID", "Churn")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        looked_up = plan_of(feature_table.lookup(labels, spark.table(name), "customerID"))
        upserted = plan_of(feature_table.upsert_rows(spark.table(name), labels.withColumn("tenure", F.lit(1)), "customerID"))
        more = labels.withColumn("tenure", F.lit(1)).drop("Churn")
        feature_table.merge(more, name, "customerID", buckets=4)
        checked = plan_of(feature_table.key_problems(spark.table(name), "customerID"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    files = {r.f for r in spark.table(f"{name}__v2").select(F.input_file_name().alias("f")).collect()}
    assert len(files) == 4  # one per bucket, although the stored rows were not shuffled
    assert spark.table(name).where("tenure = 1").count() == 50
    assert looked_up.count("Exchange hashpartitioning") == 1
    assert upserted.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning" not in checked


def test_log_grows_by_columns(spark, database):
    name = f"{database}.inference_log"
    first = spark.createDataFrame([(1, datetime(2026, 5, 7, 9))], "id int, inference_ts timestamp")
    second = spark.createDataFrame([(2, datetime(2026, 5, 8, 9), "x")], "id int, inference_ts timestamp, note string")
    for batch in (first, second, first):
        scored_log.append(batch, name)
    log = spark.table(name)
    assert sorted((r.id, r.note, str(r.inference_date)) for r in log.collect() if r.note) == [(2, "x", "2026-05-08")]
    assert log.count() == 3
    pruned = plan_of(log.where(F.col("inference_date") == "2026-05-08"))
    assert "PartitionFilters: [isnotnull(inference_date" in pruned


def log(spark, prefix, run_id, f1, batch="b1", status=run_log.FINISHED, day=1, path="p"):
    run_log.log_run(
        spark, prefix, run_id, batch, "random_forest", datetime(2026, 1, day), path, {"p": 1}, {"test_f1": f1}, [], status
    )


def test_best_run(spark, database):
    prefix = f"{database}.m"
    with pytest.raises(ValueError, match="Run log not found"):
        run_log.require_best_run(spark, prefix)
    log(spark, prefix, "failed", 0.99, status="FAILED")
    with pytest.raises(ValueError, match="no run that ended well"):
        run_log.require_best_run(spark, prefix)
    log(spark, prefix, "b", 0.7, batch="b2", day=2)
    log(spark, prefix, "a", 0.7, day=3)
    log(spark, prefix, "c", 0.6, batch="b2", day=4)
    assert run_log.require_best_run(spark, prefix) == ("a", "random_forest", {"test_f1": 0.7})
    assert run_log.require_best_run(spark, prefix, batch_id="b2")[0] == "b"
    compared = run_log.compare_models(*run_log.run_tables(spark, prefix), ["test_f1", "test_recall"])
    assert [(r.run_id, r.test_f1, r.test_recall) for r in compared.collect()][1:] == [
        ("b", 0.7, None),
        ("a", 0.7, None),
        ("c", 0.6, None),
    ]


def test_versions_aliases_and_rollback(spark, database):
    prefix = f"{database}.m"
    log(spark, prefix, "r1", 0.5, path="/models/r1")
    log(spark, prefix, "r2", 0.6, path="/models/r2")
    store = Registry(spark, prefix)
    with pytest.raises(AliasNotFound):
        store.version_of("m", "champion")
    assert store.promote("m", "r1") == (1, 2)
    with pytest.raises(LookupError, match="no earlier version"):
        store.roll_back("m")
    assert store.promote("m", "r2") == (3, 4)
    assert store.register("other", "r1") == 1
    assert store.version_of("m", "champion") == 3 and store.version_of("m", "serving") == 4
    assert store.model_path("m", 3) == "/models/r2" and store.model_path("m", 2) == "/models/r1"
    with pytest.raises(LookupError, match="no version 9"):
        store.model_path("m", 9)
    resolved = registry.resolve_aliases(store._table("aliases"), store._table("versions"), spark.table(f"{prefix}_runs"))
    assert {(r.alias, r.version, r.run_id) for r in resolved.collect()} == {("champion", 3, "r2"), ("serving", 4, "r2")}
    assert store.roll_back("m") == 1
    assert store.version_of("m", "champion") == 1 and store.version_of("m", "serving") == 4


def test_two_jobs_register_at_once(spark, database):
    """Two registries of one prefix, each in a thread: 100 versions without gaps, and 20 runs logged beside them."""
    prefix = f"{database}.m"
    given = {}

    def register(job):
        store = Registry(spark, prefix)
        given[job] = [store.register("m", f"{job}-{i}") for i in range(50)]
        for i in range(10):
            log(spark, prefix, f"{job}-{i}", i / 10)

    jobs = [threading.Thread(target=register, args=(name,)) for name in ("a", "b")]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    assert sorted(given["a"] + given["b"]) == list(range(1, 101))
    kept = {r.version: r.run_id for r in Registry(spark, prefix)._table("versions").collect()}
    assert all(kept[v] == f"{job}-{i}" for job, own in given.items() for i, v in enumerate(own)) and len(kept) == 100
    runs, metrics = run_log.run_tables(spark, prefix)
    assert runs.count() == metrics.count() == 20
    assert run_log.require_best_run(spark, prefix)[0] == "a-9"


def test_records_keep_values_and_refuse_taken_names(spark, database):
    name, schema = f"{database}.kept", "k string, at timestamp, x double, n int"
    assert records.read(spark, name, schema).count() == 0
    at = datetime(2026, 3, 1, 12, 30, 15, 123456, timezone.utc)
    rows = [("é\n\"", at, 0.1 + 0.2, 7), (None, None, None, None), ("nan", at, float("nan"), -1)]
    assert records.publish(spark, name, schema, rows, "one")
    opened = records.read(spark, name, schema)
    assert not records.publish(spark, name, schema, [("other", at, 1.0, 1)], "one")
    assert records.publish(spark, name, schema, [("two", at, 1e300, 2)])
    found = {r.k: r for r in records.read(spark, name, schema).collect()}
    assert found["é\n\""].x == 0.1 + 0.2 and found["é\n\""]["at"].astimezone(timezone.utc) == at
    assert found[None].x is None and found["nan"].x != found["nan"].x and found["two"].x == 1e300 and len(found) == 4
    assert opened.columns == ["k", "at", "x", "n"]
    spark.range(1).write.saveAsTable(f"{database}.parquet_table")
    with pytest.raises(ValueError, match="not of records"):
        records.publish(spark, f"{database}.parquet_table", "id long", [(1,)])


def test_latest_alias_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([], registry.ALIASES)
    many = spark.range(1000).select(
        F.concat(F.lit("m"), F.col("id") % 2).alias("name"), F.lit("champion").alias("alias"), F.col("id").cast("int").alias("version"),
        F.current_timestamp().alias("set_at"),
    )
    assert "Partial" in plan_of(registry.latest_aliases(many))
    assert {r.version for r in registry.latest_aliases(many).collect()} == {998, 999}
    assert registry.latest_aliases(df).count() == 0


def test_schema_of_samples(spark):
    assert customers(spark, 1).schema.simpleString() == T.StructType.fromDDL(SCHEMA).simpleString()


def test_a_hot_key_is_split_in_a_lookup(spark):
    """Half of the label rows have one key; adaptive execution cuts that partition up."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        number = F.col("id")
        labels = spark.range(0, 200_000, 1, 8).select(
            F.when(number % 2 == 0, 7).otherwise(number).alias("k"), F.sha1(number.cast("string")).alias("label")
        )
        features = spark.range(0, 200_000, 3).select(F.col("id").alias("k"), F.col("id").alias("f"))
        found = feature_table.lookup(labels, features, "k")
        assert len(found.collect()) == 200_000
        assert "skew=true" in plan_of(found)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("wide", [False, True])
def test_a_hot_key_is_spread_over_a_bucketed_table(spark, database, monkeypatch, wide):
    """Half of the rows have one key and a tenth none: no task holds more than twice the median, buckets stay put."""
    if wide:
        monkeypatch.setattr(feature_table, "MOST_HOT_BYTES", -1)
    name, number = f"{database}.parts", F.col("id")
    features = spark.range(0, 60_000, 2).select(F.col("id").alias("k"), (F.col("id") * 3).alias("f"))
    feature_table.create(features, name, "k", buckets=8)
    key = F.when(number % 2 == 0, 10).when(number % 10 != 1, number)
    labels = spark.range(0, 80_000, 1, 8).select(key.alias("k"), number.alias("label"))
    assert feature_table.frequent_keys(labels, "k", 1 / 32) == [10]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = feature_table.lookup_spread(labels, spark.table(name), "k", tasks=8)
        plan = plan_of(found)
        wanted = {(label, k, 3 * k if k is not None and k % 2 == 0 and k < 60_000 else None) for k, label in labels.collect()}
        assert {(r.label, r.k, r.f) for r in found.collect()} == wanted and found.count() == len(wanted)
        if not wide:
            assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
            held = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
            assert held[-1] <= 2 * held[len(held) // 2]
        assert feature_table.lookup_spread(labels, spark.table(name), "k", exclude=("k",), tasks=8).columns == ["label", "f"]
        nothing = feature_table.lookup_spread(labels.where("k is null"), spark.table(name), "k")
        assert nothing.count() == 8_000 and nothing.where("f is not null").count() == 0
        assert feature_table.lookup_spread(labels.limit(0), spark.table(name), "k").collect() == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_log_refuses_what_its_type_cannot_hold(spark, database):
    name = f"{database}.typed_log"
    row = lambda v, kind: spark.sql(f"SELECT CAST({v} AS {kind}) AS V, TIMESTAMP'2026-01-01' AS inference_ts")
    scored_log.append(row(1, "int"), name)
    scored_log.append(row(2, "bigint").withColumnRenamed("V", "v"), name)
    scored_log.append(row(3.0, "double"), name)
    with pytest.raises(Exception, match="cannot hold"):
        scored_log.append(row(3.9, "double"), name)
    with pytest.raises(Exception, match="cannot hold"):
        scored_log.append(row(5_000_000_000, "bigint"), name)
    assert sorted(r[0] for r in spark.table(name).select("V").collect()) == [1, 2, 3]


def test_merge_of_some_columns_keeps_the_others(spark, database):
    name = f"spark_catalog.{database}.partly"
    feature_table.write(spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, x int, y string"), name, "k")
    feature_table.write(spark.createDataFrame([(1, 11), (3, 31)], "k int, x int"), name, "k")
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 11, "a"), (2, 20, "b"), (3, 31, None)]
    assert feature_table.retire(spark, name) == [1]
    assert spark.table(name).count() == 3


def test_csv_names_and_long_numbers(spark, database, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n9007199254740993, 7\n3.7,\n,x\n")
    schema = T.StructType.fromDDL("a long, b double")
    found = load_csv_table(spark, str(tmp_path / "t.csv"), schema, f"{database}.loaded", ["a", "b"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(9007199254740993, 7.0), (None, None), (None, None)], key=str)
    with pytest.raises(Exception):
        load_csv(spark, str(tmp_path / "t.csv"), T.StructType.fromDDL("b long, a double"), ["a", "b"]).collect()


def test_rolling_back_never_comes_back(spark, database):
    models = registry.Registry(spark, f"{database}.m")
    for version in (1, 2, 3):
        models.set_alias("m", registry.CHAMPION, version)
    assert [models.roll_back("m") for _ in range(2)] == [2, 1]
    with pytest.raises(LookupError):
        models.roll_back("m")
    models.set_alias("m", registry.CHAMPION, 4)
    assert models.roll_back("m") == 3
