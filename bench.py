"""Benchmark: headline queries from the raw sources at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs the whole chain (fixture derivation -> quality/staging -> aggregates ->
warehouse -> question) and is forced with the ``noop`` sink (full execution, no collect).
One warm-up pass over all queries, then the median of $BENCH_REPEAT runs per query. Also times the full
daily run (landing + quality + staging + aggregates + audit + warehouse upsert, all
written) and, with $BENCH_REPLICAS > 1, the same run over that many key-offset copies.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.registry import queries  # noqa: E402
from tallyspark.session import build_session, fresh_dir  # noqa: E402

HEADLINE = ["q1_top_customers", "q2_churn_risk", "q3_revenue_usage_mismatch", "q4_monthly_trend",
            "q5_session_mix", "dw_user_analytics", "stg_billing", "stg_sessions", "quarantine_all",
            "agg_arpu", "volume_anomaly"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          **{"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    qs = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:                               # warm-up pass (JIT, codegen, listings)
        run(name)
    results = {name: round(statistics.median(run(name) for _ in range(repeat)), 3)
               for name in HEADLINE}

    from tallyspark.plans.pipeline import run_pipeline
    from tallyspark.sources.fixtures import sources
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        res = run_pipeline(spark, sources(spark, sf_dir), fresh_dir(spark, "bench-pipeline"),
                           billing_mode="full", land=True)
        times.append(time.perf_counter() - t0)
        assert all(v == "ok" for v in res.status.values()), res.status
    results["full_pipeline"] = round(statistics.median(times), 3)

    replicas = int(os.environ.get("BENCH_REPLICAS", "0"))
    if replicas > 1:                                    # scaled run: key-offset copies
        from tallyspark.sources.fixtures import replicate
        t0 = time.perf_counter()
        res = run_pipeline(spark, replicate(sources(spark, sf_dir), replicas),
                           fresh_dir(spark, "bench-pipeline-x"), billing_mode="full", land=True)
        assert all(v == "ok" for v in res.status.values()), res.status
        results[f"full_pipeline_x{replicas}"] = round(time.perf_counter() - t0, 3)

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
