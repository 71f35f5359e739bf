"""Command line for spark-submit: refresh the layers, or ask the stored gold tables.

    python -m goldpan refresh --layout csv --input /data/raw --output /data/lake
    python -m goldpan report --lake /data/lake
    python -m goldpan select --lake /data/lake "SELECT regiao, avg(pct_atrasados) FROM gold_state GROUP BY regiao"
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from goldpan.operators.adhoc import AGENT_ROWS, try_select
from goldpan.plans import medallion, reports
from goldpan.sources import publication, star_tables, store_csv
from goldpan.sources.writers import COLUMNAR, write_bronze

GOLD_VIEWS = ("gold_state", "gold_class", "gold_kpis")


def refresh(spark: SparkSession, args: argparse.Namespace) -> int:
    """Load bronze, build every layer as a new version, test and publish it.

    The exit code is 1 if a quality test fails; the version is then not published, and readers keep the one before.
    """
    if args.layout == "csv":
        bronze = write_bronze(store_csv.bronze(spark, args.input), f"{args.output}/bronze", args.format, store_csv.BUCKET_KEYS, args.buckets)
        model = medallion.from_store_csv(spark, bronze)
    else:
        bronze = star_tables.bronze(spark, args.input)
        if args.buckets:
            bronze |= write_bronze({t: bronze[t] for t in star_tables.BUCKET_KEYS}, f"{args.output}/bronze", args.format, star_tables.BUCKET_KEYS, args.buckets)
        model = medallion.from_star_tables(bronze)
    tables, version = medallion.refresh_and_publish(spark, model, args.output, args.format, args.buckets)
    checks = tables["dq_report"]
    checks.orderBy("table", "column", "test").show(len(medallion.LAYER_CHECKS) + 1, truncate=False)
    if version is None:
        return 1
    print(f"published {version.version}")
    for name in publication.prune(spark, args.output, args.keep):
        print(f"removed {name}")
    return 0


def _gold(spark: SparkSession, args: argparse.Namespace, name: str):
    version = publication.current(spark, args.lake)
    if version is None:
        raise SystemExit(f"nothing is published below {args.lake}")
    return version.read(spark, name)


def report(spark: SparkSession, args: argparse.Namespace) -> int:
    """Show every dashboard dataset and answer whole; each has at most one row per state."""
    for name, frame in reports.report(_gold(spark, args, "gold_state")).items():
        print(name)
        frame.show(max(1, frame.count()), truncate=False)
    return 0


def select(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one query over the gold views and show at most ``--rows`` rows."""
    for name in GOLD_VIEWS:
        _gold(spark, args, name).createOrReplaceTempView(name)
    rows, error = try_select(spark, args.sql, args.rows, GOLD_VIEWS)
    if rows is None:
        print(error, file=sys.stderr)
        return 1
    rows.show(args.rows, truncate=False)
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="goldpan")
    parser.add_argument("--format", default=COLUMNAR, help="format of the stored layers")
    commands = parser.add_subparsers(required=True)
    command = commands.add_parser("refresh", help="build all layers from raw tables")
    command.add_argument("--layout", choices=("csv", "star"), default="csv")
    command.add_argument("--input", required=True)
    command.add_argument("--output", required=True)
    command.add_argument("--keep", type=int, default=2, help="published versions to keep")
    command.add_argument("--buckets", type=int, default=0, help="buckets of tables keyed on the order, about one per 128 MB of the largest; 0 for none")
    command.set_defaults(run=refresh)
    command = commands.add_parser("report", help="dashboard datasets and answers")
    command.add_argument("--lake", required=True)
    command.set_defaults(run=report)
    command = commands.add_parser("select", help="one query over the gold tables")
    command.add_argument("--lake", required=True)
    command.add_argument("--rows", type=int, default=AGENT_ROWS)
    command.add_argument("sql")
    command.set_defaults(run=select)
    args = parser.parse_args(argv)
    return args.run(SparkSession.builder.appName("goldpan").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
