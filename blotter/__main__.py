"""Command line: the producer, the batch job and the alert stream.

    python -m blotter produce --csv PATH|GLOB --out DIR [--first] [--max-rows N]
    python -m blotter produce --csv PATH --kafka HOST:PORT --topic T
    python -m blotter batch  --sf-dir DIR [--out DIR] [--hash murmur|md5]
    python -m blotter batch  --crimes GLOB --arrests GLOB --stations GLOB --violence GLOB
                             --registry GLOB [--out DIR] [--first]
    python -m blotter alerts --source DIR --out DIR [--window 300] [--slide 60]
                             [--threshold 50] [--event-time [--watermark "10 minutes"]] [--once]
    python -m blotter alerts --kafka HOST:PORT --topic T --out DIR ...

Session settings (master, partitions, checkpoint folder) come from
spark-submit / spark-defaults; the output folder should be shared storage.
"""

from __future__ import annotations

import argparse
import json

from .session import apply_scale_settings, build_session


def _batch(args) -> dict:
    from .plans.batch import RawInputs, run
    csvs = [args.crimes, args.arrests, args.stations, args.violence, args.registry]
    if any(csvs) and not all(csvs):
        raise SystemExit("give all five of --crimes --arrests --stations --violence --registry")
    if not any(csvs) and not args.sf_dir:
        raise SystemExit("give --sf-dir or the five CSV inputs")
    spark = build_session(app="blotter-batch")
    apply_scale_settings(spark, csvs if all(csvs) else [f"{args.sf_dir}/*.parquet"])
    source = (RawInputs.from_csv(spark, *csvs, first_match=args.first)
              if all(csvs) else args.sf_dir)
    return run(spark, source, args.out, hash_method=args.hash)


def _produce(args) -> dict:
    """CSV rows -> producer rules -> keyed JSON messages (folder or topic)."""
    from pyspark.sql import functions as F

    from .functions.parse import iso_utc
    from .schemas import EVENT_FIELDS
    from .sources.connectors import kafka_write_options, keyed_json
    from .sources.files import PLACE, first_rows, resolve_first, with_place
    from .streaming.events import accepted_events, produce_events
    spark = build_session(app="blotter-produce")
    path = resolve_first(spark, args.csv) if args.first else args.csv
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    events = accepted_events(produce_events(with_place(rows), keep=PLACE))
    # the first accepted rows in file order
    events = first_rows(events, args.max_rows) if args.max_rows else events.drop(*PLACE)
    events = events.withColumn("produced_at", iso_utc(F.current_timestamp()))
    msgs = keyed_json(events, "district", EVENT_FIELDS + ["produced_at"])
    if args.kafka:
        msgs.write.format("kafka").options(**kafka_write_options(args.kafka, args.topic)).save()
        return {"topic": args.topic}
    msgs.write.mode("append").parquet(args.out)
    return {"messages": args.out}


def _alerts(args) -> dict:
    if not (args.source or args.kafka):
        raise SystemExit("give --source DIR or --kafka HOST:PORT")
    from .operators.windows import _seconds
    from .sources.connectors import kafka_stream, kafka_text
    from .streaming.runner import MESSAGE_SCHEMA, file_stream
    from .streaming.topology import start
    spark = build_session(app="blotter-alerts")
    if args.kafka:
        messages = kafka_text(kafka_stream(spark, args.kafka, args.topic).load())
    else:
        messages = file_stream(spark, args.source, MESSAGE_SCHEMA, max_files=args.max_files)
    # Windows by arrival, as in the reference: no event is ever late. By event time,
    # events later than the watermark go to the late table.
    q, sink = start(messages, args.out, args.window, args.slide, args.threshold, by_arrival=not args.event_time,
                    delay_s=_seconds(args.watermark) if args.event_time else 0, checkpoint=args.checkpoint, once=args.once)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if args.once:  # nothing more comes in this run: send the windows that are still open
        sink.close(spark, str(q.id))
    return {"alerts": f"{args.out}/alerts", "alert_logs": f"{args.out}/alert_logs", "archive": f"{args.out}/archive",
            "quarantine": f"{args.out}/quarantine", "late": f"{args.out}/late", "checkpoint": args.checkpoint or f"{args.out}/_checkpoint"}


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="blotter")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("produce", help="publish CSV rows as keyed JSON messages")
    r.add_argument("--csv", required=True)
    r.add_argument("--first", action="store_true", help="only the first sorted glob match")
    r.add_argument("--out")
    r.add_argument("--kafka")
    r.add_argument("--topic", default="crime_events")
    r.add_argument("--max-rows", type=int, default=0)
    b = sub.add_parser("batch", help="write the six result tables")
    b.add_argument("--sf-dir", help="driver tables (inputs derived from them)")
    for name in ("crimes", "arrests", "stations", "violence", "registry"):
        b.add_argument(f"--{name}", help=f"{name} CSV path or glob")
    b.add_argument("--first", action="store_true", help="only the first sorted match of each glob")
    b.add_argument("--out")
    b.add_argument("--hash", default="murmur", choices=["murmur", "md5"])
    a = sub.add_parser("alerts", help="run the stream: archive, quarantine, late events, window alerts")
    a.add_argument("--source")
    a.add_argument("--kafka")
    a.add_argument("--topic", default="crime_events")
    a.add_argument("--out", required=True)
    a.add_argument("--checkpoint")
    a.add_argument("--window", type=int, default=300)
    a.add_argument("--slide", type=int, default=60)
    a.add_argument("--threshold", type=int, default=50)
    a.add_argument("--watermark", default="10 minutes")
    a.add_argument("--max-files", type=int, default=16)
    when = a.add_mutually_exclusive_group()
    when.add_argument("--by-arrival", action="store_true", help="windows by arrival time (the default)")
    when.add_argument("--event-time", action="store_true",
                      help="windows by the events' own time; events behind the watermark go to the late table")
    a.add_argument("--once", action="store_true", help="process what is there, then stop")
    args = p.parse_args(argv)
    out = {"produce": _produce, "batch": _batch, "alerts": _alerts}[args.cmd](args)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
