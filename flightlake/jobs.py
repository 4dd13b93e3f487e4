"""Runnable jobs (``spark-submit flightlake/jobs.py <command> ...`` or
``python -m flightlake.jobs <command> ...``).

  flight-stream    raw flight states (Kafka topic or drop folder) -> star schema
  airport-stream   airport envelopes (Kafka topic or drop folder) -> 8 tables
  extrapolate      next snapshot from the two latest in a snapshot table
  snapshot-ingest  snapshot documents -> snapshot table
  fold             fold complete batches of the stored tables while streams run
  compact          folded copy of stored star tables at rest
  dashboard        one dashboard query over the stored tables, printed or saved

Credentials for JDBC come from the environment variables named by
``--jdbc-user-env`` / ``--jdbc-password-env``, never from the command line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import time

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    from flightlake.session import get_session
    return get_session(master=args.master, shuffle_partitions=args.shuffle_partitions,
                       app_name=f"flightlake-{args.command}")


def _source(spark, args):
    from flightlake.sources.streams import file_stream, kafka_stream
    if args.kafka:
        return kafka_stream(spark, args.kafka, args.topic, starting_offsets=args.starting_offsets,
                            max_offsets_per_trigger=args.max_offsets_per_trigger)
    return file_stream(spark, args.inbox, whole_file=args.whole_file,
                       clean_source=args.clean_source, archive_dir=args.archive_dir)


def _trigger(args):
    if args.available_now:
        return {"availableNow": True}
    return args.trigger


def flight_stream(args) -> None:
    from flightlake.streaming.pipelines import flight_star_stream
    spark = _session(args)
    q = flight_star_stream(_source(spark, args), args.warehouse, args.checkpoint,
                           trigger=_trigger(args), keep_category=args.keep_category,
                           quarantine_path=args.quarantine, metrics_path=args.metrics,
                           snapshots=args.whole_file)
    q.awaitTermination()


def airport_stream(args) -> None:
    from flightlake.streaming.pipelines import airport_stream as start
    spark = _session(args)
    jdbc = None
    if args.jdbc_url:
        jdbc = {"url": args.jdbc_url, "properties": {
            "user": os.environ.get(args.jdbc_user_env, ""),
            "password": os.environ.get(args.jdbc_password_env, ""),
            "driver": args.jdbc_driver}}
    q = start(_source(spark, args), args.checkpoint, tables_path=args.tables, jdbc=jdbc,
              trigger=_trigger(args), show=args.show, metrics_path=args.metrics,
              quarantine_path=args.quarantine)
    q.awaitTermination()


def extrapolate(args) -> None:
    from flightlake.operators import snapshots
    from flightlake.operators.extrapolate import extrapolate as run
    from flightlake.operators.extrapolate import to_documents
    spark = _session(args)
    prev, curr = snapshots.latest_two(spark, args.snapshots)
    if curr is None:
        print("no snapshot yet", file=sys.stderr)
        return
    job_time = args.job_time if args.job_time is not None else int(time.time())
    nxt = run(curr, prev, job_time, key_index=args.key_index, steps=args.steps,
              fix_booleans=args.fix_booleans)
    # Generated snapshots go to their own table: the pair read above stays
    # the two latest real snapshots (cycle n of a generator is --steps n).
    if args.documents:
        documents = to_documents(nxt, page_size=args.page_size)
        documents.select("page_no", "value").write.partitionBy("page_no").text(args.documents)
    else:
        snapshots.write_snapshot(nxt, args.output)


def snapshot_ingest(args) -> None:
    """Snapshot documents of a folder into the snapshot table, page by page."""
    from flightlake.operators.parse import snapshot_split
    from flightlake.operators.snapshots import write_snapshot
    from flightlake.sources.streams import read_messages
    spark = _session(args)
    write_snapshot(snapshot_split(read_messages(spark, args.inbox, whole_file=True)), args.snapshots,
                   page=args.page, page_no=args.page_no, load_id=args.load_id)


def fold(args) -> None:
    """Dimensions, days of the fact before a date, and routed tables."""
    from flightlake.operators.route import fold_routed
    from flightlake.plans.star_load import close_days, fold_dimensions
    spark = _session(args)
    if args.warehouse:
        print(fold_dimensions(spark, args.warehouse))
        if args.close_before:
            print({"closed": close_days(spark, args.warehouse, args.close_before)})
    if args.tables:
        print({"routed": fold_routed(spark, args.tables)})


def compact(args) -> None:
    from flightlake.plans.star_load import compact as run
    run(_session(args), args.warehouse, args.output)


def dashboard(args) -> None:
    from flightlake.plans import airfields as air
    from flightlake.plans import dashboard as dash
    from flightlake.plans.star_load import dashboard_tables, read_star
    from flightlake.operators import filters, route
    from flightlake.sources.streams import read_table
    spark = _session(args)
    lo, hi = args.lo, args.hi
    if args.query in ("q9", "q10", "q11", "q12"):
        table = {"q9": "airfields", "q10": "hotspots", "q11": "airfields", "q12": "airports"}
        stored = (read_table(spark, args.table) if args.table
                  else route.read_routed(spark, args.tables, table[args.query]))
        t = filters.adhoc_filter(stored, args.filter)
        out = {"q9": air.airfield_preview, "q10": air.hotspot_geo_score,
               "q11": air.airfield_table, "q12": air.country_altitude}[args.query](t)
    else:
        fact, dims, times = dashboard_tables(spark, args.warehouse)
        whole = fact
        fact = filters.country_filter(fact, args.country)
        fact = filters.adhoc_filter(fact, args.filter)
        if fact is not whole:
            times = None  # the last reading of the rows that are left
        if args.last_minutes is not None:  # the dashboards' default window
            now = dt.datetime.now(dt.timezone.utc)
            lo, hi = now - dt.timedelta(minutes=args.last_minutes), now
        out = {
            "q1": lambda: dash.fleet_status(fact, lo, hi, times),
            "q2": lambda: dash.live_map(fact, *(dims or (None,) * 3), lo=lo, hi=hi),
            "q3": lambda: dash.status_over_time(fact, dims, lo, hi),
            "q4": lambda: dash.share_of_total(dash.status_split(fact, lo, hi, times), "nb_avions"),
            "q5": lambda: dash.top_countries(fact, lo, hi),
            "q6": lambda: dash.vertical_over_time(fact, dims, lo, hi),
            "q7": lambda: dash.altitude_bands(fact, lo, hi, times=times),
            "q8": lambda: dash.country_options(read_star(spark, args.warehouse)["dim_pays"]),
        }[args.query]()
    if args.output:
        out.write.mode("overwrite").parquet(args.output)
    else:
        print("\t".join(out.columns))
        rows = out if args.rows is None else out.limit(args.rows)
        for r in rows.toLocalIterator():
            print("\t".join(map(str, r)))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="flightlake.jobs")
    p.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    p.add_argument("--shuffle-partitions", type=int, default=200)
    sub = p.add_subparsers(dest="command", required=True)

    def source_args(sp, whole_file=False):
        sp.add_argument("--kafka", help="bootstrap servers; else --inbox is read")
        sp.add_argument("--topic")
        sp.add_argument("--starting-offsets", default="earliest")
        sp.add_argument("--max-offsets-per-trigger", type=int, default=None)
        sp.add_argument("--inbox", help="drop folder of message files")
        sp.add_argument("--whole-file", action="store_true", default=whole_file)
        sp.add_argument("--clean-source", choices=["delete", "archive"], default=None)
        sp.add_argument("--archive-dir", default=None, help="with --clean-source archive")
        sp.add_argument("--checkpoint", required=True, help="folder that all nodes share")
        sp.add_argument("--trigger", default=None, help='e.g. "10 seconds"')
        sp.add_argument("--available-now", action="store_true")
        sp.add_argument("--metrics", default=None, help="parquet folder for per-batch row counts")

    f = sub.add_parser("flight-stream")
    source_args(f)
    f.add_argument("--warehouse", required=True)
    f.add_argument("--keep-category", action="store_true")
    f.add_argument("--quarantine", default=None)
    f.set_defaults(func=flight_stream)

    a = sub.add_parser("airport-stream")
    source_args(a)
    a.set_defaults(starting_offsets="latest", trigger="10 seconds")
    a.add_argument("--tables", default=None, help="parquet folder of the 8 tables")
    a.add_argument("--jdbc-url", default=None)
    a.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    a.add_argument("--jdbc-user-env", default="FLIGHTLAKE_JDBC_USER")
    a.add_argument("--jdbc-password-env", default="FLIGHTLAKE_JDBC_PASSWORD")
    a.add_argument("--show", action="store_true")
    a.add_argument("--quarantine", default=None, help="folder for messages that yield no item")
    a.set_defaults(func=airport_stream)

    e = sub.add_parser("extrapolate")
    e.add_argument("--snapshots", required=True, help="real snapshot table (partitioned by time)")
    e.add_argument("--output", help="table for generated snapshots")
    e.add_argument("--documents", default=None, help="new folder for whole documents (JSON text), instead of a table")
    e.add_argument("--page-size", type=int, default=10_000, help="states of a document, at most")
    e.add_argument("--job-time", type=int, default=None)
    e.add_argument("--key-index", type=int, default=None)
    e.add_argument("--steps", type=int, default=1)
    e.add_argument("--fix-booleans", action="store_true")
    e.set_defaults(func=extrapolate)

    i = sub.add_parser("snapshot-ingest")
    i.add_argument("--inbox", required=True, help="snapshot documents, one in a file")
    i.add_argument("--snapshots", required=True)
    i.add_argument("--page", default="0", help="name of this page of the snapshots")
    i.add_argument("--page-no", type=int, default=None, help="its place among the pages; default: the number that its name is")
    i.add_argument("--load-id", default=None, help="a load written again under its id replaces itself")
    i.set_defaults(func=snapshot_ingest)

    o = sub.add_parser("fold")
    o.add_argument("--warehouse", help="star tables")
    o.add_argument("--close-before", default=None, help="date; earlier days of the fact are rewritten in order")
    o.add_argument("--tables", default=None, help="folder of the 8 airport tables")
    o.set_defaults(func=fold)

    c = sub.add_parser("compact")
    c.add_argument("--warehouse", required=True)
    c.add_argument("--output", required=True, help="new folder")
    c.set_defaults(func=compact)

    d = sub.add_parser("dashboard")
    d.add_argument("query", choices=[f"q{i}" for i in range(1, 13)])
    d.add_argument("--warehouse")
    d.add_argument("--tables")
    d.add_argument("--table", default=None, help="q9-q12: one plain parquet table instead of --tables")
    d.add_argument("--lo", default=None)
    d.add_argument("--hi", default=None)
    d.add_argument("--last-minutes", type=int, default=None,
                   help="window now-N min .. now instead of --lo/--hi (dashboards use 15)")
    d.add_argument("--output", default=None)
    d.add_argument("--rows", type=int, default=None, help="print at most so many rows; default: all")
    d.add_argument("--country", default=None, help="one country, or All")
    d.add_argument("--filter", nargs=3, action="append", default=[], metavar=("COLUMN", "OP", "VALUE"),
                   help="ad-hoc filter, may be repeated")
    d.set_defaults(func=dashboard)
    return p


def main(argv=None) -> None:
    p = parser()
    args = p.parse_args(argv)
    if getattr(args, "clean_source", None) == "archive" and not args.archive_dir:
        p.error("--clean-source archive needs --archive-dir")
    if args.command == "extrapolate" and not (args.output or args.documents):
        p.error("extrapolate needs --output or --documents")
    args.func(args)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    main()
