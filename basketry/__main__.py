"""Command line: the daily workflow as Spark jobs.

    python -m basketry load   DATA_DIR ROOT          typed CSV load into ROOT (raw_<table>), summary
    python -m basketry stream LANDING ROOT CKPT      availableNow streaming load of new CSV files
    python -m basketry build  ROOT [--full-refresh] [--scd2-products]
                                                     staging views, marts, dims, incremental facts
    python -m basketry test   ROOT [--now TS]        data-quality report; exit 1 on a failing check
    python -m basketry report ROOT NAME              one report (e.g. rpt_segments)

ROOT is a folder on shared storage; the cluster's spark.checkpoint.dir is
used for lineage anchors.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .operators.quality import run_dq_suite
from .plans.pipeline import Models, materialize
from .session import get_session, release_anchors


def _suite_tables(m: Models):
    class T:
        def __getitem__(self, k):
            return m.raw[k] if k in m.raw else getattr(m, k)
    return T()


def main(argv=None) -> int:
    """Run one command; returns the process exit code. Intermediate tables that
    the command wrote are removed at its end."""
    try:
        return _run(argv)
    finally:
        spark = SparkSession.getActiveSession()
        if spark is not None:
            release_anchors(spark)


def _run(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="basketry")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load"); p.add_argument("data_dir"); p.add_argument("root")
    p = sub.add_parser("stream"); p.add_argument("landing"); p.add_argument("root"); p.add_argument("checkpoint")
    p = sub.add_parser("build"); p.add_argument("root"); p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--scd2-products", action="store_true")
    p.add_argument("--no-gate", action="store_true", help="build even if a check on the raw tables or staging views fails")
    p.add_argument("--threads", type=int, default=4, help="models built at the same time (default 4)")
    p.add_argument("--run-ts", help="time stamped on the models, 'YYYY-MM-DD HH:MM:SS' in UTC (default: now)")
    p = sub.add_parser("test"); p.add_argument("root"); p.add_argument("--now")
    p = sub.add_parser("report"); p.add_argument("root"); p.add_argument("name")
    args = ap.parse_args(argv)
    spark = get_session()

    if args.cmd == "load":
        from .sources.csv_loader import load_raw_csv
        _, summary = load_raw_csv(spark, args.data_dir, args.root)
        summary.show(truncate=False)
        return 0 if summary.filter("table_name = 'TOTAL' AND status = 'loaded'").count() else 1
    if args.cmd == "stream":
        from .streaming.daily_load import run_daily_load
        run_daily_load(spark, args.landing, args.root, args.checkpoint)
        return 0
    run_ts = getattr(args, "run_ts", None) or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    m = Models.from_tables(spark, args.root, run_ts)
    if args.cmd == "build":
        written = materialize(m, args.root, load=False, full_refresh=args.full_refresh,
                              scd2_products=args.scd2_products, threads=args.threads, gate=not args.no_gate)
        for name, path in written.items():
            print(f"{name}\t{path}")
        return 0
    if args.cmd == "test":
        now = args.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        materialize(m, args.root, names=[n for n in ("stg_orders", "stg_order_products", "stg_products",
                                                      "stg_aisles", "stg_departments")], load=False)
        from .sources import tables
        for name in ("customer_360", "product_performance", "dim_dates", "dim_users", "dim_departments",
                     "dim_products", "fact_orders", "fact_order_products"):
            m.use(name, tables.read(spark, args.root, name))
        report = run_dq_suite(_suite_tables(m), now=now).cache()
        report.orderBy("table_name", "column_name", "check_name").show(200, truncate=False)
        return 1 if report.filter("status IN ('fail', 'error')").count() else 0
    if args.cmd == "report":
        from .sources import tables
        for name in ("customer_360", "product_performance", "dim_users", "dim_products", "fact_orders",
                     "fact_order_products"):
            m.use(name, tables.read(spark, args.root, name))
        m.report(args.name).show(100, truncate=False)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
