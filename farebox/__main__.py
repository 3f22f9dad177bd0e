"""Batch job entry point: ``python -m farebox --raw DIR --zones DIR --out DIR``.

Runs the pipeline over all raw files (or, with ``--incremental``, one availableNow pass
over files not seen before), writes the gate report, the trips table and the rollups under
``--out``, materialises the fifteen views as parquet tables under ``--out/views`` and prints
the gate's counts (of the run, or of the last batch) as one JSON line.  ``--jdbc-url`` also
publishes the four tables over JDBC, in either mode; the password comes from the environment.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans.catalog import register_views
from .plans.pipeline import DEDUP, run_pipeline
from .session import LIBRARY_CONF
from .sources.sinks import JDBC_CONNECTIONS, write_table
from .sources.trips import read_trips
from .sources.zones import read_zones
from .streaming.compaction import compact
from .streaming.incremental import BATCH, incremental_load


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="farebox", description=__doc__.splitlines()[0])
    p.add_argument("--raw", required=True, help="folder of raw trip parquet files")
    p.add_argument("--zones", help="folder or file of the zone lookup CSV (header line)")
    p.add_argument("--out", required=True, help="output folder (shared storage)")
    p.add_argument("--incremental", action="store_true", help="one availableNow pass over new files")
    p.add_argument("--no-views", action="store_true", help="do not write the view tables")
    p.add_argument("--fractions", choices=("fail", "null"), default="fail",
                   help="a fraction in a whole-number column fails the job or becomes NULL")
    p.add_argument("--dedup", choices=tuple(DEDUP), default="exchange",
                   help="find exact copies by exchanging every row, or digests first")
    p.add_argument("--compact-after", type=int, default=0, metavar="N",
                   help="with --incremental: rewrite the store's batches as one when N or more are live")
    p.add_argument("--jdbc-url", help="also publish the four tables to this JDBC database")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", default="JDBC_PASSWORD", help="environment variable that holds the password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-connections", type=int, default=JDBC_CONNECTIONS)
    return p.parse_args(argv)


def run_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    for key, value in LIBRARY_CONF.items():
        spark.conf.set(key, value)
    zones = read_zones(spark, args.zones) if args.zones else None
    props = {k: v for k, v in (("user", args.jdbc_user), ("password", os.environ.get(args.jdbc_password_env)),
                               ("driver", args.jdbc_driver)) if v}
    options = {"jdbc_url": args.jdbc_url, "jdbc_properties": props, "jdbc_connections": args.jdbc_connections,
               "on_fraction": args.fractions, "dedup": args.dedup}
    if args.incremental:
        store = incremental_load(spark, args.raw, zones, args.out, **options)
        if args.compact_after:
            compact(spark, store, args.compact_after)
        tables = [store.read_trips(spark), spark.read.parquet(store.daily), spark.read.parquet(store.hourly)]
        tables += [store.read_vendors(spark), store.read_moments(spark)]
        routes = store.read_routes(spark)
        reports = spark.read.parquet(store.report)
        last = reports.agg(F.max(BATCH)).first()[0]
        report = reports.where(F.col(BATCH) == last).first()
        mode = "incremental"
    else:
        result = run_pipeline(spark, read_trips(spark, args.raw), zones, args.out, **options)
        tables = [result.trips, result.daily, result.hourly, result.vendors, result.moments]
        routes = result.routes
        report = result.report.first()
        mode = "batch"
    summary = {"mode": mode, "total_rows": report["total_rows"], "passed_rows": report["passed_rows"],
               "failed_by_rule": {r["rule"]: r["failed_rows"] for r in report["rules"]}}
    if not args.no_views:
        names = register_views(spark, *tables, ordered=False, routes=routes)
        for name in names:
            write_table(spark.table(name), f"{args.out}/views/{name}")
        summary["views"] = len(names)
    return summary


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("farebox").getOrCreate()
    print(json.dumps(run_job(spark, args)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
