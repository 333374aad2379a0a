"""Command-line entry points (run under spark-submit or plain python).

    python -m lumenlog.cli stream --bootstrap broker:9092 --topic incidents --root <shared folder>
    python -m lumenlog.cli report kpis --input <enriched folder> --out <output folder>
    python -m lumenlog.cli compact --input <enriched folder> --packed <folder>
    python -m lumenlog.cli chat --requests <JSON lines> --out <output folder>

``stream`` starts the enriched sink (or, with a schema registry, the intake with its
quarantine) and the alert sink over one Kafka source and blocks until either query
stops.  ``report`` answers one read-side question over the stored enriched rows and
writes the result as a Parquet (or JSON) table.  ``compact`` packs hours of small
files.  ``chat`` makes prompts of chat requests.  No rows are collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _session(ui: bool = False) -> SparkSession:
    """Session for a command; the web UI stays off unless ``--ui`` is given."""
    from .session import ENGINE_CONF
    spark = (SparkSession.builder.appName("lumenlog")
             .config("spark.ui.enabled", str(ui).lower())
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


def cmd_stream(args) -> None:
    from .session import run_folder, shared_root
    from .sources.stream import read_kafka
    spark = _session(args.ui)
    root = args.root or run_folder(spark, "stream")
    if not args.root:
        print(f"output under {root} (from {shared_root(spark)})")
    wire = read_kafka(spark, args.bootstrap, args.topic, starting_offsets=args.starting_offsets,
                      fail_on_data_loss=args.fail_on_data_loss)
    run_stream(spark, wire, root, args, {"processingTime": args.trigger})
    spark.streams.awaitAnyTermination()


def run_stream(spark: SparkSession, wire, root: str, args, trigger: dict) -> list:
    """The queries of ``stream`` over any source of wire records.  With ``--registry`` rows
    are decoded by their schema's layout and split into valid and quarantined ones;
    with ``--first-only`` a window alerts once, from keyed state."""
    from .streaming.batchlog import BatchLog
    from .streaming.crossing import start_first_crossings
    from .streaming.intake import read_registry, start_intake
    from .streaming.jobs import incident_stream, start_alert_sink, start_enriched_sink
    if args.batch_log:
        spark.streams.addListener(BatchLog(spark, args.batch_log))
    registry = read_registry(spark, args.registry) if args.registry else None
    incidents = incident_stream(wire, framed=not args.plain, registry=registry)
    if args.registry:
        first = start_intake(wire, f"{root}/intake", args.registry, f"{root}/_checkpoints/intake", trigger=trigger, query_name="intake")
    else:
        first = start_enriched_sink(incidents, f"{root}/enriched", f"{root}/_checkpoints/enriched", fmt=args.format,
                                    hour=args.hour, trigger=trigger, query_name="enriched")
    if args.first_only:
        second = start_first_crossings(incidents, f"{root}/crossings", f"{root}/_checkpoints/crossings", trigger=trigger,
                                       query_name="crossings", state_partitions=args.state_partitions)
    else:
        second = start_alert_sink(incidents, f"{root}/alerts", f"{root}/_checkpoints/alerts", trigger=trigger,
                                  query_name="alerts", state_partitions=args.state_partitions)
    return [first, second]


def cmd_compact(args) -> None:
    """Pack the hours of a stored table; ``report --packed`` reads it through the manifest."""
    from .schemas import ENRICHED_SCHEMA
    from .sinks.compaction import compact_hours
    spark = _session(args.ui)
    packed = compact_hours(spark, args.input, args.packed, ENRICHED_SCHEMA, args.hour_col, args.target_mb << 20, args.before)
    for r in packed.orderBy("hour").toLocalIterator():
        print(f"{r.hour}: {r.files} files, {r.bytes} bytes")


def cmd_chat(args) -> None:
    """Chat requests (JSON lines: message, incident_context, history) to prompts."""
    from pyspark.sql import functions as F

    from .operators.prompts import chat_prompt
    from .schemas import CHAT_REQUEST_SCHEMA
    spark = _session(args.ui)
    asked = spark.read.schema(CHAT_REQUEST_SCHEMA).json(args.requests).withColumn("conv_id", F.monotonically_increasing_id())
    out = chat_prompt(asked)
    (out.write.mode("overwrite").json(args.out) if args.out_format == "json" else out.write.mode("overwrite").parquet(args.out))


def cmd_report(args) -> None:
    from .plans.readside import load_feed, report
    spark = _session(args.ui)
    hours = tuple(args.hours.split(",")) if args.hours else None
    if args.packed:
        from .operators.feed import clean_feed
        from .schemas import ENRICHED_SCHEMA
        from .sinks.compaction import read_hours
        feed = read_hours(spark, args.input, args.packed, ENRICHED_SCHEMA, args.hour_col)
        feed = clean_feed(feed.where(feed[args.hour_col].between(*hours)) if hours else feed)
    else:
        feed = load_feed(spark, args.input, fmt=args.format, hour_range=hours, hour_col=args.hour_col)
    out = report(feed, args.name, level=args.level, service=args.service, incident_id=args.incident_id)
    w = out.write.mode("overwrite")
    (w.json(args.out) if args.out_format == "json" else w.parquet(args.out))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="lumenlog")
    ap.add_argument("--ui", action="store_true", help="enable the Spark web UI (off by default)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="run the enriched sink and the alert sink")
    s.add_argument("--bootstrap", required=True)
    s.add_argument("--topic", required=True)
    s.add_argument("--root", help="output folder on shared storage (default: under spark.checkpoint.dir)")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--fail-on-data-loss", action="store_true")
    s.add_argument("--trigger", default="1 minute")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    s.add_argument("--hour", default="ingest", choices=["ingest", "event"])
    s.add_argument("--plain", action="store_true", help="values are plain JSON, not framed")
    s.add_argument("--first-only", action="store_true", help="alert once per window")
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--registry", help="schema registry table (schema_id, version): decode by schema, quarantine bad rows")
    s.add_argument("--batch-log", help="folder for a line per micro-batch")
    s.set_defaults(fn=cmd_stream)

    c = sub.add_parser("compact", help="pack the hours of stored incidents by their bytes")
    c.add_argument("--input", required=True)
    c.add_argument("--packed", required=True, help="folder of the packed hours and their manifest")
    c.add_argument("--hour-col", default="ingest_hour")
    c.add_argument("--target-mb", type=int, default=128)
    c.add_argument("--before", help="pack hours before this one only, 'yyyy-MM-dd_HH'")
    c.set_defaults(fn=cmd_compact)

    q = sub.add_parser("chat", help="prompts for chat requests")
    q.add_argument("--requests", required=True, help="JSON lines with message, incident_context and history")
    q.add_argument("--out", required=True)
    q.add_argument("--out-format", default="parquet", choices=["parquet", "json"])
    q.set_defaults(fn=cmd_chat)

    from .plans.readside import ONE_REPORTS, REPORTS
    r = sub.add_parser("report", help="answer one read-side question over stored incidents")
    r.add_argument("name", choices=sorted([*REPORTS, *ONE_REPORTS]))
    r.add_argument("--input", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    r.add_argument("--out-format", default="parquet", choices=["parquet", "json"])
    r.add_argument("--hours", help="inclusive hour range 'yyyy-MM-dd_HH,yyyy-MM-dd_HH'")
    r.add_argument("--hour-col", default="ingest_hour")
    r.add_argument("--packed", help="folder of packed hours (see compact); Parquet input only")
    r.add_argument("--level", default="All")
    r.add_argument("--service", default="All")
    r.add_argument("--incident-id", help="for the reports on one incident")
    r.set_defaults(fn=cmd_report)

    args = ap.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
