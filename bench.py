"""Benchmark: seconds per headline query at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``; median of ``$BENCH_RUNS`` warm runs. Every query is
run once to warm up, then the timed runs go round-robin over all queries so
no query gains from its position in the list.

Each query is executed in full with the ``noop`` sink (nothing is collected).
Stream keys run their Structured Streaming query end to end, so their time
includes staging the message files and the micro-batches. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blotter.operators import rollups  # noqa: E402
from blotter.plans import catalog  # noqa: E402
from blotter.plans.catalog import QUERIES  # noqa: E402
from blotter.session import build_session  # noqa: E402

HEADLINE = [
    "batch_job", "clean_events", "trend_all", "rate_all", "join_left_dedup", "dedup_key", "metrics_all",
    "bucket_density", "pairs_all", "window_counts", "window_counts_panes", "alerts_batch",
    "hotspots_kmeans", "src_csv_typed", "validate_required", "stream_alerts",
    "stream_raw_archive", "serve_top_rates",
]

STREAM_KEYS = ["stream_alerts", "stream_raw_archive"]

# Comparison forms that are not separate inventory keys (reported apart from
# the headline sum).
VARIANTS = {
    "trend_all_union": lambda s, d: rollups.trend_all(catalog.crimes(s, d), method="union"),
    "trend_all_gsets": lambda s, d: rollups.trend_all(catalog.crimes(s, d), method="grouping_sets"),
    "rate_all_union": lambda s, d: rollups.rate_all(catalog.joined(s, d), method="union"),
    "rate_all_gsets": lambda s, d: rollups.rate_all(catalog.joined(s, d), method="grouping_sets"),
}


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k]
    extra = {"spark.driver.memory": os.environ.get("BENCH_MEM", "6g"),
             "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times, read offline
        log_dir = tempfile.mkdtemp(prefix="blotter-events-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                      "spark.eventLog.compress": "false"})
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = build_session(f"local[{cpus}]", app="blotter-bench",
                          shuffle_partitions=max(8, cpus * 4), extra=extra)
    jobs = {k: QUERIES[k] for k in HEADLINE}
    jobs.update(VARIANTS)
    if only:
        jobs = {k: v for k, v in jobs.items() if k in only}
    errors: dict[str, str] = {}
    for name, fn in jobs.items():
        try:
            run_once(spark, fn, sf_dir)  # warm-up
        except Exception as exc:  # report the key, keep measuring the rest
            errors[name] = repr(exc)[:300]
    samples: dict[str, list[float]] = {name: [] for name in jobs if name not in errors}
    for _ in range(runs):
        for name in samples:
            samples[name].append(run_once(spark, jobs[name], sf_dir))
    timings = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    # Stream keys also as input messages per second (the whole events table
    # passes through the parser, the window state and the sink).
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rates = {k: round(n_events / timings[k], 1) for k in STREAM_KEYS if k in timings}
    sf = os.path.basename(sf_dir).replace("sf", "")
    headline = {k: v for k, v in timings.items() if k not in VARIANTS}
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(headline.values()), 3),
        "unit": "sec",
        "queries": headline,
        "variants": {k: v for k, v in timings.items() if k in VARIANTS},
        "stream_rows_per_sec": rates,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
