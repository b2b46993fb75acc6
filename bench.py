"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registered import load_all  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "q_rate_by_segment",
    "q_group_means",
    "q_null_counts",
    "q_dq_report",
    "q_coerce_numeric",
    "q_feature_project_dedupe",
    "q_feature_upsert",
    "q_feature_store",
    "q_feature_lookup",
    "q_stratified_split",
    "q_impute_scale",
    "q_one_hot",
    "q_quantiles",
    "q_confusion_metrics",
    "q_roc_auc",
    "q_gate",
    "q_best_run",
    "q_alias_lookup",
    "q_profile_daily",
    "q_psi_categorical",
    "q_psi_numeric",
    "q_quality_daily",
    "q_monitor_refresh",
    "q_append_log",
    "q_prompt_text",
    "q_response_flatten",
    "q_batch_score",
    "q_train_logistic",
    "q_train_forest",
    "q_train_boosted",
    "q_retrain",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus=cpus, shuffle_partitions=cpus, name="bench")
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load_all()
    # the first query pays for starting the engine; that is not what is compared
    queries["q_rate_by_segment"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
