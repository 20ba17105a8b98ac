"""Command line: ``python -m keelson run SF_DIR OUT_DIR [--as-of TS] [--geo-keys 2|3]`` over
the driver's tables, ``python -m keelson run-files ORDERS OUT_DIR [--quotes DIR]
[--multi-line] ...`` over raw files.

Uses the session ``spark-submit`` provides (or a default one) and writes silver, the
star, the quality report and the star audit as Parquet under ``OUT_DIR``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from keelson.config import StarConfig
from keelson.plans.job import run, run_files


def main() -> None:
    ap = argparse.ArgumentParser(prog="keelson")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name, source in (("run", "sf_dir"), ("run-files", "orders")):
        r = sub.add_parser(name, help="bronze -> silver -> star -> audits")
        r.add_argument(source)
        r.add_argument("out_dir")
        r.add_argument("--as-of", default=None)
        r.add_argument("--geo-keys", type=int, choices=(2, 3), default=3)
    r.add_argument("--quotes", default=None)
    r.add_argument("--multi-line", action="store_true")
    args = ap.parse_args()
    spark = SparkSession.builder.appName("keelson").getOrCreate()
    star = StarConfig(geo_keys=args.geo_keys)
    if args.cmd == "run":
        out = run(spark, args.sf_dir, args.out_dir, star=star, as_of=args.as_of)
    else:
        out = run_files(spark, args.orders, args.out_dir, args.quotes, star=star,
                        as_of=args.as_of, multi_line=args.multi_line)
    for row in out["audit"].collect():
        print(f"{row.check}\t{row.value}")


if __name__ == "__main__":
    main()
