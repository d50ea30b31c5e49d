"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated names),
BENCH_RUNS (default 2; the faster run counts, the first also compiles).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from check import session
from hazardlens.plans.catalog import QUERIES

HEADLINE = (
    "label_by_source",
    "findings",
    "findings_documents",
    "findings_pages",
    "rule_counts_by_source",
    "finding_excerpt",
    "marked_listing",
    "classify_events",
    "classify_event_users",
    "classify_events_chunked",
    "corpus_summary",
    "change_log",
    "rewritten_files",
    "suggestions",
    "config_entries",
    "config_audit",
    "file_report",
    "file_report_json",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - started


def laid_out(spark, sf_dir: str, cpus: int) -> str:
    """A copy of the tables in as many files as keep all cores busy: the given ones have one row group each.

    It is made once, before anything is timed.
    """
    folder = tempfile.mkdtemp(prefix="hazardlens-bench-")
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(2 * cpus).write.parquet(f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    tables = laid_out(spark, sf_dir, int(os.environ.get("BENCH_CPUS", "8")))
    run(spark, "label_by_source", os.path.join(os.path.dirname(sf_dir), "sf0.001"))  # start-up is not measured
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    for name in names:
        times[name] = round(min(run(spark, name, tables) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
