"""Refreshes by appended days against refreshes of the whole log."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from samples import CONFIG as EVERYTHING
from samples import customers
from tidemark.operators import monitor, window_counts
from tidemark.plans import monitor_state
from tidemark.plans.monitor_state import kept_baseline, refresh_incremental, window_bounds
from tidemark.plans.monitors import monitor_log, refresh_days, write_monitors
from tidemark.sources import feature_table, scored_log

CONFIG = EVERYTHING.with_(numeric=("tenure", "TotalCharges"), categorical=("Contract",))
SUFFIXES = ("profile_metrics", "drift_metrics", "alerts", "quality_metrics")


def log(spark, n=300, days=17, seed=3, start="2026-01-05"):
    """A scored log over some days, with gaps, rows without a time and wrong predictions."""
    number = F.substring("customerID", 2, 4).cast("int")
    day = number * 7 % days
    ts = F.when(number % 29 > 0, F.lit(start).cast("timestamp") + F.make_dt_interval(days=day, hours=number % 24))
    said = F.when(number % 4 > 0, F.col("Churn")).otherwise(F.lit("Yes"))
    sure = F.when(number % 11 > 0, (number % 9) / 10.0 + F.when(F.col("Churn") == "Yes", 0.1).otherwise(0.0))
    return customers(spark, n, seed).withColumns({"prediction": said, "prediction_prob": sure, "inference_ts": ts}).where((day != 3) | number.isNull())


def rows(spark, name, suffix):
    return {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in spark.table(f"{name}_{suffix}").collect()}


def agree(spark, name, settings, base):
    """The tables of `name` hold what a refresh of the whole log gives."""
    whole = f"{name}_whole"
    write_monitors(monitor_log(spark.table(name), base, settings), whole, settings.target)
    for suffix in SUFFIXES:
        assert rows(spark, name, suffix) == rows(spark, whole, suffix), suffix


def stored_base(spark, database):
    customers(spark, 200, seed=8).withColumn("prediction", F.col("Churn")).write.saveAsTable(f"{database}.base")
    return spark.table(f"{database}.base")


@pytest.mark.parametrize("granularity", ["36 hours"])
def test_appends_add_up_to_the_whole(spark, database, granularity):
    settings, name, base = CONFIG.with_(granularity=granularity), f"{database}.log", stored_base(spark, database)
    every = log(spark)
    number = F.substring("customerID", 2, 4).cast("int")
    parts = [every.where((number % 10 < 7) & (F.col("inference_ts") < "2026-01-12")), every.where((number % 10 < 7) & (F.col("inference_ts") >= "2026-01-12")), every.where((number % 10 >= 7) | F.col("inference_ts").isNull())]
    for i, part in enumerate(parts):
        scored_log.append(part, name)
        read = refresh_incremental(spark, name, base, settings)
        if i < 2:
            assert read == sorted(str(r[0]) for r in part.select(F.to_date("inference_ts")).distinct().collect())
    agree(spark, name, settings, base)
    assert refresh_incremental(spark, name, base, settings) == []


def test_a_refresh_reads_new_days_only(spark, database, monkeypatch):
    name, base = f"{database}.log", stored_base(spark, database)
    scored_log.append(log(spark).where("inference_ts < '2026-01-15'"), name)
    refresh_incremental(spark, name, base, CONFIG)
    scored_log.append(log(spark).where("inference_ts >= '2026-01-15'"), name)
    seen, counted = [], monitor_state._counts
    monkeypatch.setattr(monitor_state, "_counts", lambda df, *a: seen.append(df) or counted(df, *a))
    monkeypatch.setattr(monitor, "fit_bins", None)  # the baseline is not read again
    refresh_incremental(spark, name, base, CONFIG)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [inference_date" in plan
    assert all(p.split("inference_date=")[1][:10] >= "2026-01-15" for p in _scanned(seen[0]))


def _scanned(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_new_columns_lost_days_and_another_baseline(spark, database):
    name, base = f"{database}.log", stored_base(spark, database)
    scored_log.append(log(spark).drop("tenure", "Contract").where("inference_ts < '2026-01-15'"), name)
    refresh_incremental(spark, name, base, CONFIG)
    scored_log.append(log(spark).where("inference_ts >= '2026-01-15'"), name)
    assert len(refresh_incremental(spark, name, base, CONFIG)) > 10
    agree(spark, name, CONFIG, base)
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (inference_date = '2026-01-06')")
    assert refresh_incremental(spark, name, base, CONFIG) == []
    agree(spark, name, CONFIG, base)
    other = base.where("tenure > 20")
    assert refresh_incremental(spark, name, other, CONFIG) == []
    agree(spark, name, CONFIG, other)


def test_a_broken_refresh_is_made_good(spark, database, monkeypatch):
    name, base = f"{database}.log", stored_base(spark, database)
    scored_log.append(log(spark).where("inference_ts < '2026-01-15'"), name)
    refresh_incremental(spark, name, base, CONFIG)
    scored_log.append(log(spark).where("inference_ts >= '2026-01-13'"), name)
    with monkeypatch.context() as broken:
        broken.setattr(monitor_state, "_metrics", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_incremental(spark, name, base, CONFIG)
    refresh_incremental(spark, name, base, CONFIG)
    agree(spark, name, CONFIG, base)


def test_a_frame_without_files_is_no_kept_baseline(spark, database):
    frame = customers(spark, 60).withColumn("prediction", F.col("Churn"))
    kept = kept_baseline(spark, frame, CONFIG, f"{database}.x", log(spark))
    assert kept.f1 == 1.0 and set(kept.edges) == set(CONFIG.numeric)
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 0


def test_counts_of_parts_add_up(spark):
    df = log(spark).withColumn("tenure", F.when(F.col("tenure") > 9, F.col("tenure")))
    even = F.substring("customerID", 2, 4).cast("int") % 2 == 0
    parts = [window_counts.value_counts(p, "inference_ts", ["tenure"], ["Contract"], "1 day") for p in (df.where(even), df.where(~even))]
    found = window_counts.profile(window_counts.added(parts[0].unionByName(parts[1])), ["tenure"])
    wanted = monitor.profile(df, "inference_ts", ["tenure"], ["Contract"])
    near = lambda t: {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in t.collect()}
    assert near(found) == near(wanted)


def test_days_are_refreshed_in_whole_windows(spark, database):
    """Days inside a longer window: the window keeps its other days, and no window stands twice."""
    name, settings = f"{database}.weekly", CONFIG.with_(granularity="7 days")
    rows_ = customers(spark, 70).withColumn("prediction", F.col("Churn"))
    dated = rows_.crossJoin(spark.range(14)).withColumn("inference_ts", F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("id").cast("int"))).drop("id")
    scored_log.append(dated, name, many_days=True)
    write_monitors(monitor_log(spark.table(name), rows_, settings), name, settings.target)
    before = {s: rows(spark, name, s) for s in SUFFIXES}
    refresh_days(spark.table(name), rows_, settings, name, date(2026, 1, 10), date(2026, 1, 12))
    assert {s: rows(spark, name, s) for s in SUFFIXES} == before
    starts = spark.table(f"{name}_profile_metrics").where("metric = 'count' AND `column` = 'tenure'").collect()
    assert len({r.window_start for r in starts}) == len(starts) and sum(r.value for r in starts) == 70 * 14


def test_bounds_of_windows(spark):
    assert window_bounds(spark, date(2026, 1, 10), date(2026, 1, 12), "7 days") == (datetime(2026, 1, 8), datetime(2026, 1, 15))
    assert window_bounds(spark, date(2026, 1, 10), date(2026, 1, 10), "1 day") == (datetime(2026, 1, 10), datetime(2026, 1, 11))


def test_open_frames_outlive_refreshes(spark, database):
    name, base = f"{database}.log", stored_base(spark, database)
    scored_log.append(log(spark).where("inference_ts < '2026-01-15'"), name)
    refresh_incremental(spark, name, base, CONFIG)
    held = spark.table(f"{name}_profile_metrics")
    n = held.count()
    scored_log.append(log(spark).where("inference_ts >= '2026-01-15'"), name)
    refresh_incremental(spark, name, base, CONFIG)
    assert held.count() == n < spark.table(f"{name}_profile_metrics").count()
    assert len(feature_table._versions(spark, f"{name}_profile_metrics")) == 2
    assert feature_table.retire(spark, f"{name}_profile_metrics", grace=1e-6) == [1]
    assert len(feature_table._versions(spark, f"{name}_profile_metrics")) == 1
