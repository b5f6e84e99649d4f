"""Job entry points (the same flows the original scripts run).

With spark-submit, give the path of this file instead of ``-m devpulse.jobs``.

    python -m devpulse.jobs report   --input PATH --output PATH [--format csv|parquet]
    python -m devpulse.jobs stream   --source kafka|files ... --output PATH --checkpoint PATH
    python -m devpulse.jobs validate-store  --input PATH
    python -m devpulse.jobs validate-report --input PATH

Paths are any Spark paths (object stores included). Session settings such as
credentials, executor sizes and shuffle partitions belong to spark-submit.
Each job performs one write or one small collect of a findings table.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from devpulse import constants as C


def _session(name: str) -> SparkSession:
    spark = SparkSession.builder.appName(name).getOrCreate()
    from devpulse.session import ensure_defaults
    return ensure_defaults(spark)


def run_report(args) -> int:
    from devpulse.operators.percentile import report_summary
    from devpulse.plans.report import percentile_report
    from devpulse.plans.staging import drop_staged
    from devpulse.sinks import write_report
    from devpulse.schemas import JSON_INPUTS
    from devpulse.sources.files import read_any, read_parquet, read_report_csv
    spark = _session("devpulse-report")
    try:
        # with a schema, JSON input needs no pass that infers one
        events = read_any(spark, args.input, JSON_INPUTS.get(args.json_schema))
        report = percentile_report(events, p=args.percentile, k=args.sigmas, min_population=args.min_population,
                                   population=args.population, method=args.method)
        write_report(report, args.output, args.format)
        # summary from the written result, not a second computation
        written = read_report_csv(spark, args.output) if args.format == "csv" else read_parquet(spark, args.output)
        report_summary(written).show(truncate=False)
    finally:
        drop_staged(spark)
    return 0


def run_stream(args) -> int:
    from devpulse.sources.files import read_event_files_stream
    from devpulse.sources.kafka import read_kafka_events
    from devpulse.streaming.etl import stream_windows
    from devpulse.streaming.sinks import REFERENCE_PARTITIONS, STREAM_PARTITIONS, write_windows_stream
    from devpulse.session import streaming_defaults
    spark = streaming_defaults(_session("devpulse-stream"))
    if args.source == "kafka":
        if not args.servers:
            raise SystemExit("--servers is required for --source kafka")
        # split hot topic partitions over the cluster's cores
        min_parts = args.min_partitions or spark.sparkContext.defaultParallelism
        source = read_kafka_events(spark, args.servers, args.topic, args.starting_offsets, args.max_offsets,
                                   fail_on_loss=not args.tolerate_data_loss, min_partitions=min_parts)
    else:
        source = read_event_files_stream(spark, args.input, max_files_per_trigger=args.max_files)
    windows = stream_windows(source, args.window, args.watermark, pre_dedup=not args.no_pre_dedup)
    layout = REFERENCE_PARTITIONS if args.minute_partitions else STREAM_PARTITIONS
    query = write_windows_stream(windows, args.output, args.checkpoint, args.trigger, layout,
                                 available_now=args.available_now,
                                 files_per_directory=args.files_per_directory or None)
    query.awaitTermination()
    return 0


def run_validate_store(args) -> int:
    from devpulse.plans.staging import drop_staged
    from devpulse.plans.validation import validate_window_store
    spark = _session("devpulse-validate-store")
    try:
        steps = validate_window_store(spark, args.input).collect()   # at most five rows
    finally:
        drop_staged(spark)
    for s in steps:
        print(f"{'PASS' if s.passed else 'FAIL'} {s.step} {s.detail}")
    return 0 if steps and all(s.passed for s in steps) else 1


def run_validate_report(args) -> int:
    from devpulse.plans.validation import validate_report_file
    spark = _session("devpulse-validate-report")
    checks = validate_report_file(spark, args.input).collect()  # six rows at most
    for c in checks:
        print(f"{c.status.upper()} {c.check} observed={c.observed}")
    return 0 if all(c.status == "pass" for c in checks) else 1


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="devpulse.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    r = sub.add_parser("report")
    r.add_argument("--input", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--format", default="csv")
    r.add_argument("--percentile", type=float, default=C.PERCENTILE)
    r.add_argument("--sigmas", type=float, default=C.OUTLIER_STD_DEVIATIONS)
    r.add_argument("--min-population", type=int, default=C.MIN_POPULATION)
    r.add_argument("--population", choices=["devices", "events"], default="devices")
    r.add_argument("--json-schema", choices=["infer", "raw", "raw-text", "windows"], default="infer",
                   help="what JSON input holds; infer reads it once more")
    r.add_argument("--method", choices=["sketch", "approx", "disc", "cont"], default="sketch")
    s = sub.add_parser("stream")
    s.add_argument("--source", choices=["kafka", "files"], default="kafka")
    s.add_argument("--servers", help="required for --source kafka")
    s.add_argument("--topic", default=C.KAFKA_TOPIC)
    s.add_argument("--starting-offsets", default=C.KAFKA_STARTING_OFFSETS)
    s.add_argument("--max-offsets", type=int, help="offsets per trigger; no limit unless given")
    s.add_argument("--tolerate-data-loss", action="store_true", help="go on when offsets have expired")
    s.add_argument("--min-partitions", type=int)
    s.add_argument("--input")
    s.add_argument("--max-files", type=int)
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--window", default=C.WINDOW_DURATION)
    s.add_argument("--watermark", default=C.WATERMARK_DELAY)
    s.add_argument("--trigger", default=C.TRIGGER_INTERVAL)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--minute-partitions", action="store_true")
    s.add_argument("--no-pre-dedup", action="store_true")
    # files per output directory and micro-batch; 0 writes straight from the aggregate
    s.add_argument("--files-per-directory", type=int, default=0)
    v = sub.add_parser("validate-store")
    v.add_argument("--input", required=True)
    w = sub.add_parser("validate-report")
    w.add_argument("--input", required=True)
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    run = {"report": run_report, "stream": run_stream, "validate-store": run_validate_store,
           "validate-report": run_validate_report}[args.job]
    return run(args)


if __name__ == "__main__":
    sys.exit(main())
