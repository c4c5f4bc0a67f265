"""Command-line entry points, one per job (``python -m triplake.cli <job>``).

Defaults come from the same environment variables the source jobs read
(``KAFKA_BOOTSTRAP``, ``KAFKA_TOPIC``, ``BRONZE_PATH``, ``SILVER_PATH``,
``CHECKPOINT_PATH``, ``PROCESS_DATE``); ``LAKE_ROOT`` names the lake folder
that holds every layer. The gate exits 1 when a check fails, so whatever
schedules the jobs stops the run there.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from triplake.config import DEFAULT_TOPIC, LakeConfig


def _date(s: str | None) -> str | None:
    if not s:
        return None
    return dt.date.fromisoformat(s).isoformat()  # validated here, not by ANSI casts


def _paths(args):
    from triplake.plans.jobs import LakePaths

    root = args.lake_root or os.getenv("LAKE_ROOT")
    if not root:
        raise SystemExit("name the lake folder with --lake-root or LAKE_ROOT (one that all executors share)")
    return LakePaths(root, bronze_root=args.bronze or os.getenv("BRONZE_PATH"),
                     silver_root=args.silver or os.getenv("SILVER_PATH"))


def _cfg(args) -> LakeConfig:
    kw = {}
    if args.default_city:
        kw["default_city"] = args.default_city
    if args.valid_cities:
        kw["valid_cities"] = tuple(c.strip() for c in args.valid_cities.split(","))
    if getattr(args, "topic", None):
        kw["topic"] = args.topic
    return LakeConfig(**kw)


def main(argv=None, spark=None) -> int:
    """Run one job; a session passed in is used and left running."""
    p = argparse.ArgumentParser(prog="triplake")
    p.add_argument("job", choices=["stream", "silver", "gate", "load-raw", "gold", "daily", "verify"])
    p.add_argument("--lake-root")
    p.add_argument("--bronze", help="Bronze folder (default: BRONZE_PATH or <lake-root>/bronze)")
    p.add_argument("--silver", help="Silver folder (default: SILVER_PATH or <lake-root>/silver)")
    p.add_argument("--date", default=os.getenv("PROCESS_DATE"), help="YYYY-MM-DD; unset = all dates")
    p.add_argument("--default-city")
    p.add_argument("--valid-cities", help="comma-separated")
    p.add_argument("--bootstrap", default=os.getenv("KAFKA_BOOTSTRAP", "kafka:29092"))
    p.add_argument("--topic", default=os.getenv("KAFKA_TOPIC", DEFAULT_TOPIC))
    p.add_argument("--checkpoint", default=os.getenv("CHECKPOINT_PATH"))
    p.add_argument("--files", help="read bus messages from parquet files here instead of Kafka")
    p.add_argument("--available-now", action="store_true", help="drain and stop instead of running")
    p.add_argument("--interval", help="processing-time trigger, e.g. '10 seconds' (the default)")
    p.add_argument("--max-offsets-per-trigger", type=int,
                   help="bound a Kafka micro-batch (drains a backlog in bounded steps)")
    p.add_argument("--max-files-per-trigger", type=int, help="bound a file-stream micro-batch")
    p.add_argument("--preview", action="store_true", help="show the written tables")
    p.add_argument("--strict-tests", action=argparse.BooleanOptionalAction, default=True,
                   help="a failed table test fails the run (the default)")
    p.add_argument("--profile", choices=["cluster"], help="session sizing profile (see session.CLUSTER_CONF)")
    args = p.parse_args(argv)

    from triplake.session import build_session, configure

    own_session = spark is None
    spark = build_session(app_name=f"triplake-{args.job}", profile=args.profile) if own_session else configure(spark)
    paths, cfg = _paths(args), _cfg(args)
    date = _date(args.date)

    if args.job == "stream":
        from triplake.sources import bus
        from triplake.streaming import bronze_stream

        src = (bus.file_stream(spark, args.files, args.max_files_per_trigger) if args.files
               else bus.kafka_stream(spark, args.bootstrap, args.topic,
                                     max_offsets_per_trigger=args.max_offsets_per_trigger))
        ckpt = args.checkpoint or f"{paths.root}/_checkpoints/bronze"
        q = bronze_stream.start(src, paths.bronze, ckpt, cfg, available_now=args.available_now,
                                interval=args.interval)
        print(f"stream: landing in {paths.bronze}, offsets in {ckpt}")
        q.awaitTermination()  # runs until stopped
        return 0

    from triplake.plans import jobs
    from triplake.sources.lake import MissingLayerError

    try:
        if args.job == "silver":
            wrote = jobs.run_silver(spark, paths, date)
            print("silver: partitions replaced" if wrote else "silver: empty selection, earlier partitions kept")
            if wrote and args.preview:
                jobs.read_silver_daily(spark, paths).orderBy("event_date", "city").show(truncate=False)
                jobs.read_silver_hourly(spark, paths).filter("is_peak_hour").orderBy(
                    "event_date", "city", "hour").show(truncate=False)
        elif args.job == "gate":
            from triplake.operators import quality as Q
            from triplake.sources import lake as rd

            report = Q.gate_report(rd.read_bronze(spark, paths.bronze),
                                   jobs.read_silver_daily(spark, paths), cfg)
            rows = report.collect()
            for layer in dict.fromkeys(r["layer"] for r in rows):
                lr = [r for r in rows if r["layer"] == layer]
                bad = [r for r in lr if not r["passed"]]
                print(f"{layer:<28} {len(lr) - len(bad)}/{len(lr)} checks hold")
                for r in bad:
                    print(f"    {r['column']}: {r['unexpected_count']} rows break {r['check']}")
            if any(not r["passed"] for r in rows):
                print("gate: closed")
                return 1
            print("gate: open")
        elif args.job == "load-raw":
            from triplake.plans import namespaces as ns

            schemas = jobs.load_raw(spark, paths)
            ns.ensure_namespaces(spark, paths)
            ns.register_raw(spark, paths, schemas)
            ns.register_staging_views(spark, paths)
        elif args.job == "gold":
            from triplake.plans import namespaces as ns
            from triplake.plans import pipeline as P

            rep = P.RunReport(None)
            ns.ensure_namespaces(spark, paths)
            for r in P.tested_gold(spark, paths, cfg, rep, args.strict_tests):  # 14 rows at most
                print(f"{r['model']:<24} {r['column_name']:<14} {r['test']:<16} {r['failures']:>8} {r['status']}")
            if not rep.ok or args.strict_tests and rep.failed_tests:
                return 1
        elif args.job == "daily":
            from triplake.operators import quality as Q
            from triplake.plans import pipeline as P

            try:
                rep = P.run_daily(spark, paths, date, cfg, strict_tests=args.strict_tests)
            except (P.TableTestError, Q.DataQualityError) as exc:
                print(f"error: {exc}")
                return 1
            for step, status, detail in rep.steps:
                print(f"{step:<14} {status:<8} {detail}")
            if not rep.ok:
                return 1
        elif args.job == "verify":
            from triplake.operators import verify as V

            V.row_counts(jobs.lake_tables(spark, paths)).show(truncate=False)
            lost = V.orphans(jobs.read_gold(spark, paths)["fct_rides"]).first()
            print(f"{V.verdict(lost)}: of {lost['total_rides']} rides {lost['orphan_drivers']} lack their driver's "
                  f"master data and {lost['orphan_riders']} their rider's")
            V.preview(jobs.read_gold(spark, paths)["fct_rides"]).show(truncate=False)
    except MissingLayerError as exc:
        print(f"error: {exc}")
        return 1
    finally:
        if own_session and args.job != "stream":
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
