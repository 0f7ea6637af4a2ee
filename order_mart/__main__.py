"""Command line: ``python -m order_mart <command> [options]``.

  run          build, check and publish the six targets
  incremental  apply status rows at/after --cutoff to the published targets
  batch        merge new rows (--sources: the new order_details/ and
               order_items/ rows, the masters in full) into the stored state
               under --batch-id, and publish; a known id changes nothing
  check        print the quality summary of the sources (publishes nothing)

Sources are four Parquet folders under --sources, or tables of a relational
database (--jdbc-url; the password is read from the environment variable
named by --jdbc-password-env, never from the command line).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from .config import build_session


def _sources(spark, args):
    """(sources, further gate rows or None)."""
    if args.jdbc_url:
        from .sources.jdbc import read_sources_jdbc
        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password_env:
            props["password"] = os.environ[args.jdbc_password_env]
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        return read_sources_jdbc(spark, args.jdbc_url, props, num_partitions=args.jdbc_partitions), None
    if args.format == "csv":
        from .sources.files import lost_values, read_sources_csv
        return read_sources_csv(spark, args.sources), lost_values(spark, args.sources)
    from .sources.tables import read_sources
    return read_sources(spark, args.sources), None


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="order_mart", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=["run", "incremental", "batch", "check"])
    p.add_argument("--sources", help="folder holding customer_master/ product_master/ order_details/ order_items/")
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet", help="of the folders under --sources")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-partitions", type=int, default=8)
    p.add_argument("--database", default="starschema")
    p.add_argument("--as-of", help="run date for validity columns (default: today)")
    p.add_argument("--cutoff", help="high-water mark for 'incremental', e.g. '2023-10-10 00:00:00'")
    p.add_argument("--variant", choices=["canonical", "pipeline", "sql"], default="canonical")
    p.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    p.add_argument("--publish-by", choices=["copy", "swap", "manifest"], default="copy")
    p.add_argument("--batch-id", help="of 'batch'")
    p.add_argument("--stage-dir")
    p.add_argument("--concurrency", type=int, default=3)
    p.add_argument("--partitioned", action="store_true",
                   help="date-partition the order-keyed targets; increments rewrite touched partitions only")
    p.add_argument("--grain", choices=["day", "month"], default="day")
    args = p.parse_args(argv)
    if not args.sources and not args.jdbc_url:
        p.error("give --sources or --jdbc-url")
    if args.publish_by == "swap" and not args.stage_dir:
        p.error("--publish-by swap needs --stage-dir")
    spark = spark or build_session()
    src, more = _sources(spark, args)
    from .plans import pipeline
    if args.command == "check":
        rows = [r.asDict() for r in pipeline.check_summary(src, {}, more=more).collect()]
        print(json.dumps(rows, default=str))
        return 1 if rows else 0
    try:
        if args.partitioned and args.command != "batch":
            from .plans import partitioned
            if args.command == "run":
                res = partitioned.run_pipeline_partitioned(spark, src, args.database, args.as_of,
                                                           stage_dir=args.stage_dir, grain=args.grain,
                                                           more_checks=more)
            else:
                if not args.cutoff:
                    p.error("incremental needs --cutoff")
                res = partitioned.run_incremental_partitioned(spark, src, args.database, args.cutoff,
                                                              args.as_of, stage_dir=args.stage_dir,
                                                              grain=args.grain, more_checks=more)
        elif args.command == "batch":
            if not args.batch_id:
                p.error("batch needs --batch-id")
            from .plans.state import apply_batch
            res = apply_batch(spark, src, args.database, args.batch_id, args.as_of, more_checks=more)
        elif args.command == "run":
            res = pipeline.run_pipeline(spark, src, args.database, args.as_of, variant=args.variant, mode=args.mode,
                                        stage_dir=args.stage_dir, concurrency=args.concurrency,
                                        publish_by=args.publish_by, more_checks=more)
        else:
            if not args.cutoff:
                p.error("incremental needs --cutoff")
            res = pipeline.run_incremental(spark, src, args.database, args.cutoff, args.as_of,
                                           stage_dir=args.stage_dir, concurrency=args.concurrency,
                                           publish_by=args.publish_by, more_checks=more)
    except pipeline.QualityError as err:
        print(json.dumps({"published": [], "violations": err.violations}, default=str))
        return 2
    print(json.dumps({"published": res.published, "violations": res.violations}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
