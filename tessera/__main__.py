"""Run a registered job by name: ``python -m tessera <job> <data_dir> [options]``.

The result is written by the executors (``--out`` folder, Parquet or text
lines) or a bounded number of rows is shown (``--show``); nothing is
gathered on the driver beyond the rows shown. ``--list`` names the jobs.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def main(argv: list[str] | None = None) -> int:
    from tessera.plans.catalog import REGISTRY

    ap = argparse.ArgumentParser(prog="python -m tessera", description=__doc__.splitlines()[0])
    ap.add_argument("job", nargs="?", help="job name (see --list)")
    ap.add_argument("data_dir", nargs="?", help="folder holding the <table>.parquet inputs")
    ap.add_argument("--out", help="write the result to this folder")
    ap.add_argument("--format", choices=["parquet", "text"], default="parquet",
                    help="output format; text writes one tab-separated line per row")
    ap.add_argument("--show", type=int, default=0, help="print this many rows")
    ap.add_argument("--master", help="Spark master for a local run, e.g. local[8]")
    ap.add_argument("--list", action="store_true", help="list the job names")
    args = ap.parse_args(argv)

    if args.list or not args.job:
        print("\n".join(sorted(REGISTRY)))
        return 0
    if args.job not in REGISTRY or not args.data_dir:
        ap.error(f"unknown job {args.job!r} or missing data_dir; --list names the jobs")

    from pyspark.sql import SparkSession

    from tessera.session import build_session
    owned = SparkSession.getActiveSession() is None
    spark = build_session(args.master, app_name=f"tessera-{args.job}")
    try:
        df = REGISTRY[args.job](spark, args.data_dir)
        if args.out:
            if args.format == "text":
                line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                           for c in df.columns])
                df.select(line.alias("value")).write.mode("overwrite").text(args.out)
                shown = spark.read.text(args.out)
            else:
                df.write.mode("overwrite").parquet(args.out)
                shown = spark.read.parquet(args.out)
            if args.show:  # from the written result: the job is not run twice
                shown.show(args.show, truncate=False)
        elif args.show:
            df.show(args.show, truncate=False)
        else:
            df.write.format("noop").mode("overwrite").save()
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
