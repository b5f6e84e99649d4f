"""Benchmark the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query is timed from plan construction to the end of its action; large
results are forced with the ``noop`` sink (computes everything, keeps
nothing), small ones are collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from devpulse import constants as C  # noqa: E402
from devpulse.operators import quality as Q  # noqa: E402
from devpulse.operators.transform import parse_events, parse_payload, project_envelope  # noqa: E402
from devpulse.plans import etl  # noqa: E402
from devpulse.plans.report import percentile_report  # noqa: E402
from devpulse.plans.validation import validate_window_store  # noqa: E402
from devpulse.sinks import write_windows  # noqa: E402
from devpulse.session import local_session, scratch_path  # noqa: E402
from devpulse.sources.files import read_event_files_stream, read_parquet  # noqa: E402
from devpulse.sources.fixtures import build_envelope  # noqa: E402
from devpulse.sources.tables import events_as_raw, load_table  # noqa: E402
from devpulse.streaming.etl import stream_windows  # noqa: E402
from devpulse.streaming.sinks import write_windows_stream  # noqa: E402


WARMUP_DIR = "/root/testdata/sf0.001"


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def plan_for(spark, sf_dir: str, cpus: str) -> dict:
    """The headline queries over the tables in ``sf_dir`` (inputs staged, queries lazy)."""
    gate = int(os.environ.get("BENCH_GATE", C.MIN_POPULATION))
    events = load_table(spark, sf_dir, "events")
    raw = events_as_raw(events)
    env = build_envelope(events)

    # The supplied tables are single-row-group files (one scan task each). The
    # envelope is staged as ``cpus`` files, as a topic with that many
    # partitions would deliver it, so the ingest queries read in parallel.
    env_path = scratch_path(spark, "bench-envelope")
    env.repartition(int(cpus)).write.parquet(env_path)
    env_files = read_parquet(spark, env_path)

    # the stored window table the validation job reads (written once, untimed)
    store_path = scratch_path(spark, "bench-store")
    write_windows(etl.window_table(env_files), store_path)

    def stream():
        out, ck = scratch_path(spark, "bench-out"), scratch_path(spark, "bench-ck")
        q = write_windows_stream(stream_windows(read_event_files_stream(spark, env_path)), out, ck,
                                 available_now=True)
        q.awaitTermination()

    return {
        "percentile_report": lambda: percentile_report(raw, min_population=gate).collect(),
        "percentile_report_exact": lambda: percentile_report(raw, min_population=gate, method="disc").collect(),
        "etl_windows_batch": lambda: noop(etl.window_table(env_files)),
        "etl_windows_stream": stream,
        "quality_report": lambda: Q.quality_report(etl.window_table(env_files)).collect(),
        "contract_check": lambda: Q.contract_violation_counts(
            parse_payload(project_envelope(env_files))).collect(),
        "reject_reasons": lambda: noop(etl.reject_reasons(parse_events(env_files, keep_corrupt=True))),
        "store_validation": lambda: validate_window_store(spark, store_path).collect(),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus))

    # Warm-up, not timed: every query once on the smallest tables, so the
    # timings below exclude JVM class loading and code generation.
    for fn in plan_for(spark, WARMUP_DIR, cpus).values():
        fn()

    times = {}
    for name, fn in plan_for(spark, sf_dir, cpus).items():
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
