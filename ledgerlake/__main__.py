"""Command line: ``python -m ledgerlake <command> --root <lake uri> ...``

  seed      write the merchant dimension and a synthetic event history
  ingest    load event files (json | text | parquet) into Bronze as one batch
  nightly   run cleanse -> reconcile -> gold -> analytics -> features
            for ``--date`` (default: yesterday) or every date (``--catchup``)
  optimize  compact and cluster the registered layer tables
  history   show the versions of a versioned table

Uses the active Spark configuration (``spark-submit`` or defaults).
"""
from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlake")
    ap.add_argument("--root", required=True, help="lake root URI (file:, hdfs:, s3a:, gs:)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("seed")
    s.add_argument("--events", type=int, default=450_000)
    s.add_argument("--days", type=int, default=90)
    s.add_argument("--anchor", default=None, help="last day of the history (default: yesterday)")
    s.add_argument("--merchants", type=int, default=500)
    s.add_argument("--batch", type=int, default=0)
    i = sub.add_parser("ingest")
    i.add_argument("path")
    i.add_argument("--format", default="json", choices=["json", "text", "parquet"])
    i.add_argument("--batch", type=int, required=True)
    n = sub.add_parser("nightly")
    n.add_argument("--date", default=None)
    n.add_argument("--catchup", action="store_true")
    n.add_argument("--run-id", default="cli")
    n.add_argument("--optimize", action="store_true")
    sub.add_parser("optimize")
    h = sub.add_parser("history")
    h.add_argument("layer")
    h.add_argument("table")
    h.add_argument("--key", action="append", required=True)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .lake import Lake
    from .plans import nightly
    spark = SparkSession.builder.appName(f"ledgerlake-{args.cmd}").getOrCreate()
    lake = Lake(spark, args.root)
    if args.cmd == "seed":
        from .sources.synthetic import merchant_reference, synthetic_events
        anchor = args.anchor or nightly.default_report_date()
        lake.overwrite(merchant_reference(spark, args.merchants), "bronze", "merchant_reference")
        ev = synthetic_events(spark.range(args.events), "id", anchor, days_back=args.days,
                              merchants=args.merchants)
        out = nightly.ingest_batch(lake, ev, args.batch)
    elif args.cmd == "ingest":
        from .sources import read_event_files
        df = read_event_files(spark, args.path, args.format)
        out = nightly.ingest_batch(lake, df, args.batch, raw_json=args.format == "text")
    elif args.cmd == "nightly":
        rd = None if args.catchup else (args.date or nightly.default_report_date())
        out = nightly.run_nightly(lake, rd, args.run_id, optimize=args.optimize)
    elif args.cmd == "optimize":
        from .operators.maintenance import optimize_tables
        out = optimize_tables(lake, nightly.TABLES)
    else:
        from .operators.history import VersionedTable
        out = [r.asDict() for r in VersionedTable(lake, args.layer, args.table, args.key).history().collect()]
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
