"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, the best counts; default 3).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

import tidegate as tg  # noqa: E402
from tidegate import storage  # noqa: E402
from tidegate.plans.queries import QUERIES  # noqa: E402

HEADLINES = [
    "insert_readback", "arrival_batches", "batch_atomic_reject", "result_ok_filter", "stream_insert",
    "type_conform", "partition_key_layout", "write_counters", "insert_time_running",
    "insert_time_final", "replay_keyed", "primary_key_audit",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tidegate-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    return spark


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def best(run, runs: int) -> float:
    return round(min(timed(run) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    seconds = {}
    for name in HEADLINES:
        def run(query=QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()                                           # warm-up: code generation, file cache
        seconds[name] = best(run, runs)

    # Overhead of an insert over a bare write of the same rows.
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")

    def bare():
        lines.write.parquet(storage.scratch_path(spark, "bare"))

    def batched():
        tg.insert(lines, path=storage.scratch_path(spark, "insert"))

    bare()
    batched()
    bare_seconds, insert_seconds = best(bare, runs), best(batched, runs)
    n_lines, n_events = lines.count(), events.count()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": {
            name: round(n_events / seconds[name])
            for name in ("insert_readback", "batch_atomic_reject", "stream_insert")
        } | {"insert_lineitem": round(n_lines / insert_seconds)},
        "bare_write_sec": bare_seconds,
        "insert_sec": insert_seconds,
        "overhead_ratio": round(insert_seconds / bare_seconds, 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
