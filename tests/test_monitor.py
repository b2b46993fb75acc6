import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from samples import CONFIG, customers
from tidemark.operators import monitor
from tidemark.plans.monitors import monitor_log, refresh_all, refresh_configured, refresh_days, refresh_summary, write_monitors
from tidemark.sources import scored_log

START = datetime(2026, 5, 1)


def log(spark, n=400, days=4, seed=3):
    """A scored log that is right about the label in four of five rows."""
    df = customers(spark, n, seed)
    number = F.substring("customerID", 2, 4).cast("int")
    right = number % 5 > 0
    flipped = F.when(F.col("Churn") == "Yes", "No").otherwise("Yes")
    ts = F.lit(START) + F.make_dt_interval(days=number % days, hours=number % 24)
    return df.withColumn("prediction", F.when(right, F.col("Churn")).otherwise(flipped)).withColumn("inference_ts", ts)


def brute_psi(base, cur, edges=None):
    def shares(values):
        out = {}
        for v in values:
            b = v if edges is None or v is None else sum(v > e for e in edges)
            out[b] = out.get(b, 0) + 1 / len(values)
        return out

    p, q = shares(base), shares(cur)
    total = 0.0
    for b in set(p) | set(q):
        x, y = max(p.get(b, 0), 1e-4), max(q.get(b, 0), 1e-4)
        total += (y - x) * math.log(y / x)
    return total


def test_drift_equals_the_direct_sum(spark):
    base = log(spark, 300, seed=1)
    cur = log(spark, 400, seed=2).withColumn("tenure", F.when(F.col("tenure") > 3, F.col("tenure") * 2))
    cur = cur.withColumn("Contract", F.when(F.col("tenure") > 60, "Five year").otherwise(F.col("Contract")))
    edges = monitor.fit_bins(base, ["tenure"])["tenure"]
    assert len(edges) == 9
    found = {
        (r.window_start, r["column"]): r.value
        for r in monitor.drift(base, cur, "inference_ts", ["tenure"], ["Contract"]).collect()
    }
    assert len(found) == 8
    base_rows, cur_rows = base.collect(), cur.collect()
    for (window, column), value in found.items():
        inside = [r[column] for r in cur_rows if window <= r.inference_ts < window + timedelta(days=1)]
        wanted = brute_psi([r[column] for r in base_rows], inside, edges if column == "tenure" else None)
        assert abs(value - wanted) < 1e-9
    alerts = monitor.drift_alerts(monitor.drift(base, cur, "inference_ts", ["tenure"], ["Contract"]), 0.2)
    assert alerts.count() == sum(v > 0.2 for v in found.values()) > 0


def test_no_drift_against_itself_and_agreement_with_the_joined_shares(spark):
    base = log(spark, 300)
    edges = monitor.fit_bins(base, ["tenure", "MonthlyCharges"])
    shares = monitor.bin_shares(monitor.binned(base, edges, ["Contract"]))
    assert all(abs(r.psi) < 1e-12 for r in monitor.psi(monitor.compare_shares(shares, shares)).collect())
    cur = log(spark, 300, days=1, seed=9).withColumn("Contract", F.lit(None).cast("string"))
    joined = monitor.psi(monitor.compare_shares(shares, monitor.bin_shares(monitor.binned(cur, edges, ["Contract"]))))
    direct = monitor.drift(base, cur, "inference_ts", ["tenure", "MonthlyCharges"], ["Contract"])
    a = {r["column"]: r.psi for r in joined.collect()}
    b = {r["column"]: r.value for r in direct.collect()}
    assert set(a) == set(b) and all(abs(a[c] - b[c]) < 1e-9 for c in a)


def test_equal_edges_are_merged(spark):
    df = spark.range(100).select(F.when(F.col("id") < 95, 1.0).otherwise(2.0).alias("v"))
    assert monitor.fit_bins(df, ["v"]) == {"v": [1.0]}
    assert monitor.fit_bins(df.where("v is null"), ["v"]) == {"v": []}


def test_profile(spark):
    df = log(spark, 200, days=2).withColumn("tenure", F.when(F.col("tenure") > 5, F.col("tenure")))
    found = {
        (r.window_start, r["column"], r.metric): r.value
        for r in monitor.profile(df, "inference_ts", ["tenure"], ["Contract"]).collect()
    }
    assert len(found) == 2 * (11 + 4)
    day = [r.tenure for r in df.where(F.col("inference_ts") < F.lit(START + timedelta(days=1))).collect()]
    known = sorted(v for v in day if v is not None)
    get = lambda m: found[(START, "tenure", m)]
    assert (get("count"), get("nulls"), get("distinct")) == (len(day), len(day) - len(known), len(set(known)))
    assert (get("min"), get("max")) == (known[0], known[-1])
    mean = sum(known) / len(known)
    assert abs(get("std") - math.sqrt(sum((x - mean) ** 2 for x in known) / len(known))) < 1e-9
    with pytest.raises(ValueError):
        monitor.profile(df, "inference_ts", [], [])


def test_quality_and_its_alerts(spark):
    df = log(spark, 400, days=4)
    label = F.when(F.col("Churn").isNotNull(), (F.col("Churn") == "Yes").cast("int"))
    said = (F.col("prediction") == "Yes").cast("int")
    by_window = monitor.quality_by_window(df, "inference_ts", label, said)
    rows = by_window.collect()
    assert len(rows) == 4 and all(r.tp + r.fp + r.fn + r.tn == 100 for r in rows)
    assert monitor.quality_alerts(by_window, 1.0, "Churn").count() == sum(1 - r.f1 > 0.05 for r in rows)
    assert monitor.quality_alerts(by_window, 0.0, "Churn").count() == 0
    assert monitor.quality_metrics(by_window, "Churn").count() == 16


def test_refresh_of_all_logs_goes_on_after_a_failure(spark, database):
    from tidemark.plans.registered import scratch_database

    other = scratch_database(spark)
    name = f"log_{database}"
    scored_log.append(log(spark), f"{database}.{name}")
    log(spark).drop("inference_ts").write.saveAsTable(f"{other}.{name}")
    base = log(spark, 300, seed=1)

    def refresh(table):
        write_monitors(monitor_log(spark.table(table), base, CONFIG), table, CONFIG.target)

    results = refresh_all(spark, name, refresh)
    assert tuple(refresh_summary(results).first()) == (1, 2)
    assert results.where("status = 'error'").first().table == f"`{other}`.`{name}`"
    drifted = spark.table(f"{database}.{name}_drift_metrics")
    assert drifted.columns == ["window_start", "column", "metric", "value"]
    assert drifted.count() == 4 * (3 + 16)
    assert spark.table(f"{database}.{name}_quality_metrics").count() == 16
    spark.sql(f"DROP DATABASE {other} CASCADE")


def test_rows_without_a_time_are_counted(spark):
    log = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, F.lit("2026-01-01 10:00:00").cast("timestamp")).alias("inference_ts"),
        F.col("id").cast("double").alias("x"),
        F.lit("a").alias("c"),
    )
    found = monitor.profile(log, "inference_ts", ["x"], ["c"]).where("metric in ('count', 'p50')").collect()
    by = {(r.window_start, r["column"], r.metric): r.value for r in found}
    assert len(by) == 6 and sum(v for (_, c, m), v in by.items() if c == "x" and m == "count") == 100
    assert by[None, "x", "count"] == 50 and by[None, "x", "p50"] == 50.0
    assert {r.window_start is None for r in monitor.drift(log, log, "inference_ts", ["x"], ["c"]).collect()} == {True, False}


def test_alerts_do_not_read_the_log_again(spark, database):
    log = customers(spark, 120).withColumns({"inference_ts": F.lit("2026-01-01").cast("timestamp"), "prediction": F.col("Churn")})
    log.write.saveAsTable(f"{database}.log")
    tables = monitor_log(spark.table(f"{database}.log"), customers(spark, 120, seed=3).withColumn("prediction", F.col("Churn")), CONFIG)
    assert "FileScan" not in tables.alerts._jdf.queryExecution().executedPlan().toString()


def test_refresh_with_the_baseline_of_the_settings(spark, database):
    rows = customers(spark, 120).withColumn("prediction", F.col("Churn"))
    rows.write.saveAsTable(f"{database}.base")
    name = f"refreshed_{database}"
    rows.withColumn("inference_ts", F.lit("2026-01-01").cast("timestamp")).write.saveAsTable(f"{database}.{name}")
    settings = CONFIG.with_(baseline_table=f"{database}.base")
    for _ in range(2):
        assert [r.status for r in refresh_configured(spark, settings, name).collect()] == ["ok"]
    assert spark.table(f"{database}.{name}_profile_metrics").count() > 0
    with pytest.raises(ValueError):
        refresh_configured(spark, CONFIG.with_(baseline_table=None), name)


def test_refresh_of_one_day_reads_one_partition(spark, database):
    rows = customers(spark, 120).withColumn("prediction", F.col("Churn"))
    at = lambda d: F.lit(f"2026-01-0{d} 12:00:00").cast("timestamp")
    name = f"{database}.daily"
    scored_log.append(rows.withColumn("inference_ts", at(1)).union(rows.withColumn("inference_ts", at(2))), name)
    write_monitors(monitor_log(spark.table(name), rows, CONFIG), name, CONFIG.target)
    before = {tuple(r) for r in spark.table(f"{name}_profile_metrics").collect()}
    scored_log.append(rows.limit(30).withColumn("inference_ts", at(2)), name)
    log = spark.table(name)
    refresh_days(log, rows, CONFIG, name, date(2026, 1, 2), date(2026, 1, 2))
    after = {tuple(r) for r in spark.table(f"{name}_profile_metrics").collect()}
    changed = {r[0].day for r in before ^ after}
    assert changed == {2} and len(after) == len(before)
    counts = {(r.window_start.day, r.value) for r in spark.table(f"{name}_profile_metrics").where("metric = 'count'").collect()}
    assert counts == {(1, 120.0), (2, 150.0)}
    pruned = log.where(F.col("inference_date").between(F.lit(date(2026, 1, 2)), F.lit(date(2026, 1, 2))))
    assert "PartitionFilters: [isnotnull(inference_date" in pruned._jdf.queryExecution().executedPlan().toString()
    assert len(pruned.inputFiles()) < len(log.inputFiles())
