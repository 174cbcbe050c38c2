"""Command line: run the streaming job, a batch backfill, or upkeep.

    python -m eventide stream --source kafka --option kafka.bootstrap.servers=host:9092 \\
        --option subscribe=activity-events --lake s3://bucket/lake --trigger "60 seconds"
    python -m eventide stream --source parquet --path /landing --lake /lake --available-now
    python -m eventide build --source json --path /landed/events --lake /lake
    python -m eventide stream ... --sink jdbc --sink-option url=jdbc:... --sink-option user=...
    python -m eventide stream ... --mode update --clean-retention 7d
    python -m eventide retain --lake /lake --tier "1 hour=30" --tier "1 day=90" --raw-days 7
    python -m eventide compact --lake /lake --before 2024-02-15
    python -m eventide repair --lake /lake                 # after stream --mark-late

The session comes from ``spark-submit`` (master, packages, memory); this
module only sets the UTC session time zone and reads the checkpoint folder
from ``spark.checkpoint.dir`` unless ``--checkpoints`` is given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import lake
from .config import ensure_session
from .functions.parse import parse_events
from .functions.timefilters import days_before
from .operators import maintenance, quality
from .operators.metrics import METRIC_TABLES
from .plans import pipeline, repair, tables
from .sources.events import event_batch, event_stream
from .streaming import runner

LAKE_TABLES = ("events", "repository_metrics", "event_type_distribution",
               "user_activity", "language_trends", "rejected_events")


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _trigger(args) -> dict | None:
    if args.available_now:
        return {"availableNow": True}
    if args.trigger:
        return {"processingTime": args.trigger}
    return None


def cmd_stream(spark: SparkSession, args) -> None:
    records = event_stream(spark, args.source, args.path, **_options(args.option))
    trig = _trigger(args)
    qs = runner.run_all(spark, records, args.lake, args.checkpoints, trig,
                        watermark=args.watermark, tables=args.tables or None,
                        sink=args.sink, sink_options=_options(args.sink_option),
                        mode=args.mode, retention=args.clean_retention, marks=args.mark_late)
    runner.await_all(spark, qs, bounded=bool(args.available_now))


def cmd_build(spark: SparkSession, args) -> None:
    records = event_batch(spark, args.source, args.path, **_options(args.option))
    parsed = parse_events(records)
    clean = pipeline.clean(parsed, dedup=not args.no_dedup)
    tables.build_tables(spark, clean, args.lake, args.tables or None,
                        quality.rejected_records(parsed), args.replace)


def _as_of(args) -> dt.date:
    return dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()


def cmd_retain(spark: SparkSession, args) -> None:
    as_of = _as_of(args)
    tiers = {w: int(n) for w, n in _options(args.tier).items()} or maintenance.DEFAULT_TIERS
    for name in args.tables or LAKE_TABLES:
        path = os.path.join(args.lake, name)
        if name in METRIC_TABLES:
            rule, least = maintenance.tier_expired(tiers, as_of.isoformat()), min(tiers.values())
        else:
            least = args.raw_days
            time = "window_end" if name == "session_activity" else "created_at"
            rule = F.col(time) < days_before(as_of.isoformat(), least)
        gone, part = lake.expire(spark, path, name, rule, as_of - dt.timedelta(days=least))
        print(f"{name}: {gone} folders deleted, {part} rewritten")


def cmd_compact(spark: SparkSession, args) -> None:
    before = dt.date.fromisoformat(args.before) if args.before else dt.date.today()
    for name in args.tables or LAKE_TABLES:
        n = lake.compact(spark, os.path.join(args.lake, name), name, before)
        print(f"{name}: {n} dates compacted")


def cmd_repair(spark: SparkSession, args) -> None:
    names = args.tables or [n for n in METRIC_TABLES
                            if lake.exists(spark, os.path.join(args.lake, n))]
    n = repair.repair(spark, args.lake, names, args.watermark, args.ended)
    print(f"{n} windows recomputed")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="eventide")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("stream", "build"):
        p = sub.add_parser(name)
        p.add_argument("--source", default="kafka",
                       help="kafka | parquet | json | orc | text")
        p.add_argument("--path", help="landing folder for file sources")
        p.add_argument("--option", action="append", help="source option key=value")
        p.add_argument("--lake", required=True, help="root folder of the served tables")
        p.add_argument("--tables", nargs="*", help="subset of the served tables")
    s = sub.choices["stream"]
    s.add_argument("--checkpoints", help="checkpoint root (default: spark.checkpoint.dir)")
    s.add_argument("--trigger", help='processing-time trigger, e.g. "60 seconds"')
    s.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    s.add_argument("--watermark", default=runner.DEFAULT_WATERMARK)
    sub.choices["build"].add_argument("--no-dedup", action="store_true")
    sub.choices["build"].add_argument("--replace", action="store_true",
                                      help="the input's dates replace the lake's as a whole")
    s.add_argument("--sink", default="lake", choices=("lake", "jdbc", "json"))
    s.add_argument("--sink-option", action="append", help="sink option key=value")
    s.add_argument("--mode", default="append", choices=("append", "update"),
                   help="update keeps open windows visible (keyed upsert)")
    s.add_argument("--clean-retention", help='age of the clean events to keep, e.g. "7d"')
    r = sub.add_parser("retain")
    r.add_argument("--lake", required=True)
    r.add_argument("--tier", action="append", help='window width and days, e.g. "1 hour=30"')
    r.add_argument("--raw-days", type=int, default=maintenance.RAW_EVENT_DAYS)
    r.add_argument("--as-of", help="YYYY-MM-DD (default: today)")
    r.add_argument("--tables", nargs="*")
    c = sub.add_parser("compact")
    c.add_argument("--lake", required=True)
    c.add_argument("--before", help="YYYY-MM-DD (default: today)")
    c.add_argument("--tables", nargs="*")
    s.add_argument("--mark-late", action="store_true",
                   help="mark the windows of late events for repair")
    f = sub.add_parser("repair")
    f.add_argument("--lake", required=True)
    f.add_argument("--tables", nargs="*", help="default: all metric tables of the lake")
    f.add_argument("--watermark", default=runner.DEFAULT_WATERMARK, help="the stream's delay")
    f.add_argument("--ended", action="store_true",
                   help="no stream writes any more: recompute open windows, too")
    args = ap.parse_args(argv)

    spark = ensure_session(SparkSession.builder.appName(f"eventide-{args.cmd}").getOrCreate())
    {"stream": cmd_stream, "build": cmd_build, "retain": cmd_retain,
     "compact": cmd_compact, "repair": cmd_repair}[args.cmd](spark, args)


if __name__ == "__main__":
    main()
