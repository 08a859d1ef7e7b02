"""Command line: the original application's three programs.

    python -m martlens offline  (--sf-dir DIR | --stored DIR | --database NAME) --condition JSON --out PATH [--jdbc-url URL]
    python -m martlens area     (--sf-dir DIR | --stored DIR | --database NAME) --out PATH
    python -m martlens realtime (--lines DIR | --servers HOSTS --topic NAME) --out PATH [--threshold N] [--available-now]

Shop tables come from a folder of base tables, from a folder written by ``fixtures.materialize`` or from
a catalog database; ad lines from text files or a Kafka topic (with the connector on the classpath).
Results go to parquet folders under ``--out`` (one per result table) or, with ``--jdbc-url``,
become the task's rows in JDBC tables (a repeated ``--task-id`` replaces them). The session comes from ``SparkSession.builder.getOrCreate()``, so
cluster settings (master, ``spark.checkpoint.dir``, sizing from ``session.cluster_conf``) are
the submitter's.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from martlens.params import AdParams
from martlens.plans import offline_job
from martlens.session import ensure_utc
from martlens.sources import adlog, fixtures, sinks
from martlens.streaming.app import start_realtime


def _sink(args):
    if args.jdbc_url:
        args.task_id = args.task_id or sinks.new_task_id()
        return lambda name, df: sinks.publish_jdbc(df, args.jdbc_url, name, args.task_id)

    def to_folder(name: str, df: DataFrame) -> None:
        sinks.replace_table(df, path=f"{args.out.rstrip('/')}/{name}")

    return to_folder


def _add_tables(ap: argparse.ArgumentParser) -> None:
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--sf-dir", help="folder of the base tables")
    source.add_argument("--stored", help="folder of the four shop tables as parquet")
    source.add_argument("--database", help="catalog database of the four shop tables")


def _tables(spark: SparkSession, args) -> fixtures.ShopTables:
    if args.database:
        return fixtures.load_catalog(spark, args.database)
    if args.stored:
        return fixtures.StoredShopTables(spark, args.stored)
    return fixtures.load(spark, args.sf_dir)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str | None:
    ap = argparse.ArgumentParser(prog="martlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    off = sub.add_parser("offline", help="R1-R5 (+R6) for one condition")
    _add_tables(off)
    off.add_argument("--condition", required=True, help="condition JSON text")
    off.add_argument("--out", default="")
    off.add_argument("--jdbc-url", default="")
    off.add_argument("--task-id", default=None)
    off.add_argument("--original-columns", action="store_true", help="write the original's column layout")
    area = sub.add_parser("area", help="R6 alone")
    _add_tables(area)
    area.add_argument("--out", default="")
    area.add_argument("--jdbc-url", default="")
    area.add_argument("--task-id", default=None)
    rt = sub.add_parser("realtime", help="R7-R10 on ad-log text files or a topic")
    source = rt.add_mutually_exclusive_group(required=True)
    source.add_argument("--lines", help="folder of text files")
    source.add_argument("--topic", help="Kafka topic")
    rt.add_argument("--servers", default="", help="bootstrap servers of the topic")
    rt.add_argument("--max-offsets", type=int, default=None, help="lines of the topic per micro-batch")
    rt.add_argument("--redelivered-within", default=None, help="drop lines that arrived before, e.g. '1 day'")
    rt.add_argument("--out", required=True)
    rt.add_argument("--threshold", type=int, default=AdParams().blacklist_threshold)
    rt.add_argument("--trigger", default="5 seconds")
    rt.add_argument("--available-now", action="store_true")
    args = ap.parse_args(argv)

    spark = spark or (
        SparkSession.builder.appName(f"martlens-{args.cmd}").config("spark.ui.enabled", "false").getOrCreate()
    )
    ensure_utc(spark)
    if args.cmd == "realtime" and args.topic and not args.servers:
        ap.error("--topic needs --servers")
    if args.cmd in ("offline", "area") and not (args.out or args.jdbc_url):
        ap.error("--out or --jdbc-url is required")
    if args.cmd == "offline":
        tables, sink = _tables(spark, args), _sink(args)
        return offline_job.run_offline(
            spark, tables, args.condition, sink, task_id=args.task_id, original_columns=args.original_columns
        )
    if args.cmd == "area":
        tables, sink = _tables(spark, args), _sink(args)
        df = offline_job.area_report(tables, task_id=args.task_id)
        sink(offline_job.AREA_TOP_TABLE, df)
        return None
    if args.topic:
        lines = adlog.read_kafka_lines(spark, args.servers, args.topic, max_offsets_per_trigger=args.max_offsets)
    else:
        lines = adlog.read_line_stream(spark, args.lines)
    queries = start_realtime(
        lines, args.out, AdParams(blacklist_threshold=args.threshold), args.trigger, args.available_now,
        redelivered_within=args.redelivered_within,
    )
    for q in queries:
        q.awaitTermination()
    return None


if __name__ == "__main__":
    main(sys.argv[1:])
