"""Command line: ``python -m shopflow daily|stream ...``.

daily   validate -> clean + load -> models -> tests over four landed CSV
        (or parquet) sources; exits non-zero on the first failing step.
stream  start the order-event ingest from Kafka or a folder of JSON-lines
        files into a landing table and a dead-letter table.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

from pyspark.sql import SparkSession

from shopflow.session import configure
from shopflow.tables import STREAM_TABLE


def _session(app: str) -> SparkSession:
    return configure(SparkSession.builder.appName(app).getOrCreate())


def cmd_daily(args) -> int:
    from shopflow.operators import quality as Q
    from shopflow.plans import jobs
    from shopflow.sources import files, sinks
    from shopflow.tables import RAW_TABLES, SourcePaths

    spark = _session("shopflow-daily")
    if args.shuffle_bytes:
        from shopflow.session import size_shuffles
        size_shuffles(spark, args.shuffle_bytes)
    root = args.sources.rstrip("/")
    paths = SourcePaths(fmt=args.format, **{n: f"{root}/{n}" for n in
                                            ("orders", "customers", "products", "order_items")})
    suites = Q.SUITES
    if args.suites:  # the gate fails a dataset whose suite file is missing
        named = {n: f"{args.suites.rstrip('/')}/{n}_suite.json" for n in Q.SUITES}
        suites = {n: Q.load_suite(p) for n, p in named.items() if os.path.exists(p)}
    extra: dict = {}
    for table, name in RAW_TABLES.items():
        if args.jdbc_url:
            extra.setdefault(table, []).append(sinks.jdbc_target(
                table, args.jdbc_url, name, user=args.jdbc_user, password=args.jdbc_password,
                driver=args.jdbc_driver, num_partitions=args.jdbc_partitions))
        if args.bigquery_project:
            extra.setdefault(table, []).append(sinks.bigquery_target(
                table, args.bigquery_project, args.bigquery_dataset, name.split(".", 1)[1]))
    landing = spark.read.parquet(args.landing) if args.landing else None
    try:
        report = jobs.run_daily(spark, files.read_available_sources(spark, paths),
                                jobs.Warehouse(args.warehouse, extra), suites=suites, landing=landing)
    except (Q.QualityGateError, jobs.ModelTestError) as e:
        logging.error("%s", e)
        return 1
    print(json.dumps(report, default=str))
    return 0


def cmd_stream(args) -> int:
    from shopflow.streaming import ingest as ING

    spark = _session("shopflow-stream")
    if args.kafka:
        messages = ING.kafka_source(spark, args.kafka, args.topic)
    else:
        messages = ING.json_file_source(spark, args.files)
    landing = None
    if args.jdbc_url:
        from shopflow.sources import sinks
        landing = sinks.jdbc_target("raw_orders_stream", args.jdbc_url, args.jdbc_table, user=args.jdbc_user,
                                    password=args.jdbc_password, driver=args.jdbc_driver,
                                    num_partitions=args.jdbc_partitions)
    targets = ING.ingest_sinks(args.output, arrivals=args.keep_late, landing=landing)
    trigger = {"availableNow": True} if args.available_now else None
    q = ING.start_ingest(messages, targets, args.checkpoint, trigger,
                         state_store=args.state_store, state_partitions=args.state_partitions,
                         **({"state_buckets": args.state_buckets} if args.state_buckets else {}))
    q.awaitTermination()
    return 0 if q.exception() is None else 1


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    p = argparse.ArgumentParser(prog="shopflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="validate, load, build models, run model tests")
    d.add_argument("--sources", required=True, help="folder holding orders/ customers/ products/ order_items/")
    d.add_argument("--format", default="csv", choices=["csv", "parquet"])
    d.add_argument("--warehouse", required=True, help="output root (<schema>/<table> folders)")
    d.add_argument("--suites", help="folder with <dataset>_suite.json files (default: built-in suites)")
    d.add_argument("--landing", help="the stream's landing table (parquet); the realtime mart is built from it, "
                                     "and without it the tests of both fail")
    d.add_argument("--jdbc-url", help="also load the raw tables into this database (truncate + insert)")
    d.add_argument("--jdbc-user")
    d.add_argument("--jdbc-password")
    d.add_argument("--jdbc-driver")
    d.add_argument("--jdbc-partitions", type=int, help="max concurrent connections per table")
    d.add_argument("--bigquery-project", help="also load the raw tables into BigQuery")
    d.add_argument("--bigquery-dataset", default="raw")
    d.add_argument("--shuffle-bytes", type=int,
                   help="expected shuffle volume; sizes the initial shuffle partitions (~128 MB each)")
    d.set_defaults(fn=cmd_daily)
    s = sub.add_parser("stream", help="order-event ingest")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of JSON-lines files")
    s.add_argument("--topic", default="orders_stream")  # = ingest.DEFAULT_TOPIC
    s.add_argument("--output", required=True, help="root of the landing and dead-letter tables")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.add_argument("--keep-late", action="store_true",
                   help="keep late and repeated rows in tables of their own instead of dropping them")
    s.add_argument("--jdbc-url", help="land valid rows in this database's table (conditional append, once a batch)")
    s.add_argument("--jdbc-table", default=STREAM_TABLE, help="the table, created beforehand with its key")
    s.add_argument("--jdbc-user")
    s.add_argument("--jdbc-password")
    s.add_argument("--jdbc-driver")
    s.add_argument("--jdbc-partitions", type=int, help="max concurrent connections")
    s.add_argument("--state-store", choices=["rocksdb"])
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--state-buckets", type=int, help="with --keep-late: groups of keys that share a state row")
    s.set_defaults(fn=cmd_stream)
    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
