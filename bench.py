"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8).  The whole pipeline first runs once, untimed, on sf0.001 to
warm code generation and the JIT; then every query is timed on
``BENCH_SF_DIR``.  Every query runs over whole tables and ends in a real sink
(Parquet in the scratch folder, or Spark's ``noop`` sink where the result is
only measured).  Fixture landing (turning tables into raw message files) is
set-up and not timed; everything after it is.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from posturn import config as C  # noqa: E402
from posturn.plans import batch  # noqa: E402
from posturn.plans import queries as Q  # noqa: E402
from posturn.plans import stream_queries as SQ  # noqa: E402
from posturn.session import build_session, scratch_path  # noqa: E402
from posturn.sources.fixtures import noisy_transaction_feed  # noqa: E402
from posturn.streaming.sources import land  # noqa: E402


WARMUP_SF_DIR = "/root/testdata/sf0.001"


def run_all(spark, sf_dir: str, root: str, cpus: int) -> tuple[dict[str, float], int, int]:
    """Land the raw feed (untimed), then time every headline query on ``sf_dir``."""

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # Set-up: land the raw (noisy) transaction messages as files, like a topic.
    landing = os.path.join(root, "landing")
    land(noisy_transaction_feed(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("key"), "value"),
         landing, files=2 * cpus)
    n_messages = spark.read.parquet(landing).count()
    n_events = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).count()

    times: dict[str, float] = {}

    def timed(name, fn) -> None:
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    validated_path = os.path.join(root, "validated")

    def stage_a() -> None:
        raw = spark.read.parquet(landing)
        batch.validate_stage(raw).write.mode("overwrite").partitionBy("outcome").parquet(validated_path)

    def stage_bc() -> None:
        pub = batch.published(spark.read.parquet(validated_path))
        usable, _ = batch.split_event_time(batch.sales_from_published(pub))
        routed = batch.publish_aggregates_stage(batch.turnover_stage(usable))
        routed.write.mode("overwrite").partitionBy("queue").parquet(os.path.join(root, "queues"))

    timed("validate_stage", stage_a)
    timed("turnover_route_stage", stage_bc)
    timed("turnover_10s", lambda: noop(Q.q_turnover_10s(spark, sf_dir)))
    timed("turnover_1h", lambda: noop(Q.q_turnover_1h(spark, sf_dir)))
    timed("turnover_merge", lambda: noop(Q.q_turnover_merge(spark, sf_dir)))
    timed("late_split", lambda: noop(Q.q_late_split(spark, sf_dir)))
    timed("turnover_on_time", lambda: noop(Q.q_turnover_on_time(spark, sf_dir)))
    timed("txn_envelope", lambda: noop(Q.q_txn_envelope(spark, sf_dir)))
    timed("lag_histogram", lambda: noop(Q.q_lag_histogram(spark, sf_dir)))
    timed("generic_fold", lambda: noop(Q.q_generic_fold(spark, sf_dir)))
    timed("stream_turnover", lambda: noop(SQ.q_stream_turnover(spark, sf_dir)))
    timed("stream_strict_late", lambda: noop(SQ.q_stream_strict_late(spark, sf_dir)))
    timed("stream_strict_late_scan", lambda: noop(SQ.q_stream_strict_late_scan(spark, sf_dir)))
    return times, n_messages, n_events


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="posturn-bench", shuffle_partitions=2 * cpus)
    spark.sparkContext.setLogLevel("ERROR")
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    root = scratch_path(spark, "bench", str(int(time.time() * 1000)))

    # Warm-up, not timed: the same pipeline once on the smallest tables, so
    # the timed pass measures steady-state throughput rather than the
    # one-off code generation and JIT compilation of each plan.
    warmup_times, _, _ = run_all(spark, WARMUP_SF_DIR, os.path.join(root, "warmup"), cpus)
    times, n_messages, n_events = run_all(spark, sf_dir, os.path.join(root, "timed"), cpus)

    total = round(sum(times.values()), 3)
    out = {
        "metric": "total_wall_seconds_headline_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "rows_per_sec": {
            "validate_stage": round(n_messages / times["validate_stage"], 1),
            "turnover_10s": round(n_events / times["turnover_10s"], 1),
        },
        "cpus": cpus,
        "warmup_sf0.001_sec": round(sum(warmup_times.values()), 3),
        "window_seconds": C.WINDOW_LENGTH_SECONDS,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
