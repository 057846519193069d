"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up, then three times; the median wall time is
reported.  Queries execute through the ``noop`` sink, so the whole plan runs
but nothing is collected to the driver.  Rows out come from a separate,
untimed count; shuffle bytes per run from Spark's event log, written to a
fresh scratch folder (no UI, no REST).  Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roaskit.plans.catalog import QUERIES  # noqa: E402
from roaskit.session import get_spark  # noqa: E402

HEADLINE = [
    "attribution_last_touch", "session_revenue", "creative_summary", "creative_rollup", "payback_curve",
    "channel_roas", "monthly_trends", "overall_cac", "kpi_summary", "customer_mix", "wholesale_kpis",
    "order_lines_valid", "table_profile", "chronological_split", "auc_exact", "bootstrap_ci",
    "unpivot_months", "email_funnel", "ingest_stream_result",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="roaskit-bench-events-")
    spark = get_spark("roaskit-bench", cpus=cpus,
                      conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    sc = spark.sparkContext
    times, rows_out = {}, {}
    for name in names:
        fn = QUERIES[name]
        sc.setJobDescription(f"bench:{name}")
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        sc.setJobDescription(f"rows:{name}")
        rows_out[name] = fn(spark, sf_dir).count()
        sc.setJobDescription(None)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    spark.stop()
    shuffle = shuffle_bytes_per_run(log_dir, runs + 1)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "runs": runs, "rows_out": rows_out,
                      "shuffle_bytes_per_run": {k: shuffle.get(k, 0) for k in times}}))


def shuffle_bytes_per_run(log_dir: str, executions: int) -> dict:
    """Shuffle bytes written per query execution, from the event log: stages
    are mapped to the job description they ran under ("bench:<name>")."""
    stage_desc, written = {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path, encoding="utf-8", errors="replace") as f:
            for line in f:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    for sid in ev.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif '"SparkListenerTaskEnd"' in line:
                    ev = json.loads(line)
                    b = ((ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    written[ev.get("Stage ID")] = written.get(ev.get("Stage ID"), 0) + (b or 0)
    out: dict = {}
    for sid, b in written.items():
        d = stage_desc.get(sid, "")
        if d.startswith("bench:"):
            out[d[6:]] = out.get(d[6:], 0) + b
    return {k: int(v / executions) for k, v in out.items()}


if __name__ == "__main__":
    main()
