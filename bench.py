"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default all)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from signalmill.catalog import QUERIES  # noqa: E402
from signalmill.session import local_session  # noqa: E402

HEADLINE = [
    "flatten_spans", "flatten_logs", "flatten_metrics", "dedup_spans", "dedup", "dedup_metrics",
    "service_health_5min", "service_health", "service_health_hourly", "assemble_traces",
    "assemble_traces_windowed", "service_dependencies", "infer_dependencies", "orphan_spans", "enrich_logs",
    "metrics_rollup", "metrics_rollup_hourly_percentiles", "rerollup_hourly", "histogram_rollup",
    "merge_histograms", "histogram_quantile", "merge_exp_histograms", "summary_quantiles",
    "anomaly_baselines", "detect_anomalies", "validate_trace_completeness", "validate_cross_signal",
    "ingest_lag", "window_gaps", "rollup_gaps", "route_summary", "multi_resolution",
    "stream_service_health", "stream_dedup", "stream_metrics_rollup", "trace_spans", "trace_lookup", "body_matches",
    "trace_waterfall", "root_causes", "tail_sample", "seasonal_baselines", "change_scores", "health_resolutions", "log_templates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)
    QUERIES["flatten_spans"](spark, sf_dir).limit(1).collect()  # start the JVM's engine before the clock runs
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
