"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line. Every query is executed in full
through the ``noop`` sink (no driver collect) and timed including its own fits:
the encoder/model caches of the query registry are cleared before each query. Every query
runs once on sf0.001 first (untimed JVM/JIT warm-up).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "decision_metrics", "threshold_table", "segment_analysis", "run_all_checks", "impute_apply",
    "woe_numeric", "woe_transform", "iv_table", "evaluate_all", "compare_models",
    "el_by_decision", "el_sensitivity", "psi_report", "psi_variables", "psi_by_period",
    "correlation_pairs", "top_drivers", "calibrated_scores", "training_run", "rf_scores", "cv_metrics", "psi_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from riskframe.plans import registry
    from riskframe.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8), app="riskframe-bench")
    registry.load_all()
    import riskframe.plans.q_models as qm
    import riskframe.plans.q_woe as qw

    # JVM/JIT warm-up: every headline query once on the smallest tables, not timed, so the
    # timings below are steady-state execution rather than first-use class loading.
    for name in HEADLINE:
        registry.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        qw._MODEL_CACHE.clear()
        qm._CACHE.clear()
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
