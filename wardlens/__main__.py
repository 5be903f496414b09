"""Command line: load bronze files, build silver and gold, print the check reports.

    python -m wardlens load DATABASE SOURCE PATH [--replace | --again] [--names skip|check|map]
    python -m wardlens ingest DATABASE SOURCE FOLDER --checkpoint PATH [--strict]
    python -m wardlens rejects DATABASE SOURCE [--load ID]
    python -m wardlens build DATABASE [--clusters] [--buckets N] [--partitions N]
    python -m wardlens report DATABASE

--work FOLDER, before the step, names the folder the cluster shares, unless spark.checkpoint.dir does.
"""

from __future__ import annotations

import argparse

from wardlens.plans import pipeline
from wardlens.session import build_session
from wardlens.sources import bronze
from wardlens.sources.tables import recent_loads, rejected_rows
from wardlens.streaming.ingest import ingest_table


def main() -> None:
    parser = argparse.ArgumentParser(prog="wardlens")
    parser.add_argument("--work")
    steps = parser.add_subparsers(dest="step", required=True)
    load = steps.add_parser("load")
    load.add_argument("database")
    load.add_argument("source", choices=sorted(bronze.SOURCES))
    load.add_argument("path")
    load.add_argument("--replace", action="store_true", help="put the files in place of the whole table")
    load.add_argument("--again", action="store_true", help="put files in place of their earlier rows")
    load.add_argument("--names", choices=["skip", "check", "map"], default="skip")
    ingest = steps.add_parser("ingest")
    ingest.add_argument("database")
    ingest.add_argument("source", choices=["admissions", "beds", "codes", "chapters"])
    ingest.add_argument("folder")
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--strict", action="store_true", help="stop at a bad file instead of putting it aside")
    rejects = steps.add_parser("rejects")
    rejects.add_argument("database")
    rejects.add_argument("source", choices=sorted(bronze.SOURCES))
    rejects.add_argument("--load")
    build = steps.add_parser("build")
    build.add_argument("database")
    build.add_argument("--clusters", action="store_true")
    build.add_argument("--buckets", type=int)
    build.add_argument("--partitions", type=int)
    report = steps.add_parser("report")
    report.add_argument("database")
    args = parser.parse_args()

    spark = build_session(**({"spark.checkpoint.dir": args.work} if args.work else {}))
    if args.step == "load":
        spark.sql(f"create database if not exists {args.database}")
        report = bronze.load(
            spark, args.database, args.source, args.path, args.replace, args.again, args.names
        )
        report.show(truncate=False)
    elif args.step == "rejects":
        rejected_rows(spark, f"{args.database}.{bronze.TABLES[args.source]}", args.load).show(100, truncate=False)
    elif args.step == "ingest":
        spark.sql(f"create database if not exists {args.database}")
        table = ingest_table(spark, args.folder, args.database, args.checkpoint, args.source, quarantine=not args.strict)
        recent_loads(spark, table).show(truncate=False)
    elif args.step == "build":
        pipeline.build(spark, args.database, buckets=args.buckets, partitions=args.partitions)
        if args.clusters:
            pipeline.build_clusters(spark, args.database)
    else:
        pipeline.show_reports(spark, args.database)


if __name__ == "__main__":
    main()
