"""Command line: the two load steps a daily job runs, and the questions.

    python -m innkeeper staging   --listings L --reviews R --calendar C --neighbourhoods N --out ROOT
    python -m innkeeper warehouse --staging ROOT/staging/v=... --out ROOT
    python -m innkeeper questions --warehouse ROOT/warehouse/v=... [--month 2027-01] [--range 2026-12-29:2027-01-02]
        [--q1-month 2027-01 --q2-month 2026-11 --q4-month 2027-03]

``staging`` reads the four raw CSV extracts (gzip or plain) and publishes a
validated staging version; ``warehouse`` builds, checks and publishes the star
from a staging version (default: the published one under ``--out``).  Both exit
non-zero on a fatal data-quality violation.  The session comes from
``spark-submit`` / ``SparkSession.builder`` settings; ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from innkeeper import schemas, session
from innkeeper.operators.quality import DataQualityError
from innkeeper.plans import analytics as A
from innkeeper.plans import pipeline as P
from innkeeper.sources import files


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="innkeeper")
    p.add_argument("--master", default=None, help="Spark master for local runs, e.g. local[8]")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("staging")
    for name in ("listings", "reviews", "calendar", "neighbourhoods"):
        s.add_argument(f"--{name}", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--date-format", default="yyyy-MM-dd")
    s.add_argument("--report-only", action="store_true", help="do not fail on fatal rules")
    w = sub.add_parser("warehouse")
    w.add_argument("--staging", default=None, help="staging version; default: the published one under --out")
    w.add_argument("--out", required=True)
    w.add_argument("--report-only", action="store_true")
    q = sub.add_parser("questions")
    q.add_argument("--warehouse", required=True, help="a warehouse version directory")
    q.add_argument("--month", default=None, help="YYYY-MM for Q1, Q2 and Q4 (each can be overridden)")
    for n in ("q1", "q2", "q4"):
        q.add_argument(f"--{n}-month", default=None, help=f"YYYY-MM for {n.upper()}")
    q.add_argument("--range", default=None, help="START:END for Q5 (inclusive ISO dates)")
    q.add_argument("--guests-month", type=int, default=4)
    q.add_argument("--min-days", type=int, default=7)
    q.add_argument("--guests-range", type=int, default=5)
    return p


def _session(master: str | None):
    if master:
        return session.build_session(master)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("innkeeper").getOrCreate()
    session.ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = _session(args.master)
    try:
        if args.command == "staging":
            raw = {
                "listings": files.scan_csv(spark, args.listings, schemas.LISTING_COLUMNS),
                "reviews": files.scan_csv(spark, args.reviews, schemas.RAW_REVIEWS),
                "calendar": files.scan_csv(spark, args.calendar, schemas.RAW_CALENDAR, multiline=False),
                # untidy headers are normalised in staging, so no name check here
                "neighbourhoods": files.scan_csv(spark, args.neighbourhoods),
            }
            result = P.run_staging(spark, raw, f"{args.out.rstrip('/')}/staging", not args.report_only, args.date_format)
            print(json.dumps({"staging": result.path, "metrics": result.metrics,
                              "report": [r.asDict() for r in result.report]}, default=str))
        elif args.command == "warehouse":
            root = args.out.rstrip("/")
            staging = args.staging or files.current_version(spark, f"{root}/staging")
            built = P.run_warehouse(spark, staging, f"{root}/warehouse", not args.report_only)
            print(json.dumps({"warehouse": built.path, "row_counts": built.row_counts,
                              "report": [r.asDict() for r in built.report]}, default=str))
        else:
            star = P.read_star(spark, args.warehouse)
            out = {"q3_priciest_neighbourhood": A.priciest_neighbourhoods(star, 1)}
            months = {n: getattr(args, f"{n}_month") or args.month for n in ("q1", "q2", "q4")}
            ym = {n: tuple(int(x) for x in v.split("-")) for n, v in months.items() if v}
            if "q1" in ym:
                out["q1_cheapest_most_available"] = A.cheapest_most_available(star, *ym["q1"])
            if "q2" in ym:
                out["q2_most_reviewed"] = A.most_reviewed(star, *ym["q2"])
            if "q4" in ym:
                out["q4_family_stay"] = A.recommend_month(star, args.guests_month, args.min_days, *ym["q4"])
            if args.range:
                start, end = args.range.split(":")
                out["q5_range_stay"] = A.recommend_range(star, args.guests_range, start, end)
            print(json.dumps({k: [r.asDict() for r in df.collect()] for k, df in out.items()}, default=str))
        return 0
    except DataQualityError as err:
        print(f"data-quality check failed: {err}", file=sys.stderr)
        return 2
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
