"""Command-line daily run: land the three sources, run the pipeline, print step status as JSON.

    python -m tallyspark --customers c.csv --billing b.csv --sessions s.csv --out /warehouse \\
        [--format csv|parquet] [--t-start 2024-05-18 --t-end 2024-05-19] [--mode incremental|full]
        [--as-of "2024-05-19 03:00:00"] [--max-bad-ratio 0.05] [--iso-text-dates] [--reconcile-days 7]
        [--stamp-changed-only] [--grain month|day] [--gate-min-rows 1000] [--monitor]
        [--keep-bad-lines] [--unknown-customer]

Without --t-start the window is the day before the run date (as-of); --t-end defaults to
t-start + 1 day. Uses the active Spark session (spark-submit) or creates a local one.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from . import params as P


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="tallyspark", description=__doc__.splitlines()[0])
    ap.add_argument("--customers", required=True)
    ap.add_argument("--billing", required=True)
    ap.add_argument("--sessions", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--t-start", type=dt.date.fromisoformat)
    ap.add_argument("--t-end", type=dt.date.fromisoformat)
    ap.add_argument("--mode", choices=["incremental", "full"], default="incremental")
    ap.add_argument("--as-of", type=dt.datetime.fromisoformat)
    ap.add_argument("--max-bad-ratio", type=float)
    ap.add_argument("--iso-text-dates", action="store_true")
    ap.add_argument("--reconcile-days", type=int, default=0)
    ap.add_argument("--stamp-changed-only", action="store_true")
    ap.add_argument("--grain", choices=["month", "day"], default="month")
    ap.add_argument("--gate-min-rows", type=int)
    ap.add_argument("--monitor", action="store_true")
    ap.add_argument("--unknown-customer", action="store_true", help="a placeholder row for revenue of customers that are not staged yet")
    ap.add_argument("--keep-bad-lines", action="store_true", help="quarantine and count CSV lines that cannot be read, instead of failing")
    ap.add_argument("--master", default="local[*]")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> dict:
    from pyspark.sql import SparkSession

    from .plans.pipeline import run_pipeline
    from .session import build_session, configure
    from .sources.readers import land

    args = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.getActiveSession() or build_session(args.master)
    configure(spark)
    as_of = args.as_of or dt.datetime.now().replace(microsecond=0)
    locations = {P.SRC_CUSTOMERS: args.customers, P.SRC_BILLING: args.billing, P.SRC_SESSIONS: args.sessions}
    sources = {name: land(spark, name, path, args.format, load_time=as_of, keep_corrupt=args.keep_bad_lines) for name, path in locations.items()}
    res = run_pipeline(spark, sources, args.out, t_start=args.t_start, t_end=args.t_end, as_of=as_of,
                       billing_mode=args.mode, max_bad_ratio=args.max_bad_ratio, land=True,
                       iso_text_dates=args.iso_text_dates, reconcile_days=args.reconcile_days,
                       stamp_changed_only=args.stamp_changed_only, grain=args.grain, gate_min_rows=args.gate_min_rows,
                       monitor=args.monitor, unknown_customer=args.unknown_customer)
    report = {"status": res.status, "tables": res.tables, "seconds": res.seconds, "metrics": res.metrics}
    print(json.dumps(report, indent=2, default=str))
    return report


if __name__ == "__main__":
    report = main()
    sys.exit(0 if all(v == "ok" for v in report["status"].values()) else 1)
