"""Command line: build and publish the mart, look at it, search it, export and verify files.

    spark-submit --py-files ... -m tessera mart --data DIR --root DIR
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import dashboard, publish
from tessera.plans.mart import TABLES, Mart
from tessera.sources import exports
from tessera.sources.binding import relations

RELATIONS = ("products", "ids", "launches", "labels", "entities")


def load(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """The relations as Parquet folders of --data, or bound to the driver's tables in --sf."""
    if args.sf:
        return relations(spark, args.sf)
    return {name: spark.read.parquet(f"{args.data}/{name}") for name in RELATIONS}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str, data: bool = True) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        if data:
            source = p.add_mutually_exclusive_group(required=True)
            source.add_argument("--data")
            source.add_argument("--sf")
        for a in arguments:
            p.add_argument(a)
        return p

    command("mart").add_argument("--root", required=True)
    command("table").add_argument("name", choices=(*TABLES, "core_metrics"))
    command("list").add_argument("name", choices=tuple(dashboard.LISTS))
    s = command("search")
    for option in ("query", "label", "entity-type", "entity"):
        s.add_argument(f"--{option}", default="")
    s.add_argument("--sort", default="recent")
    s.add_argument("--limit", type=int, default=24)
    s.add_argument("--offset", type=int, default=0)
    command("product", "slug")
    command("snapshot", "path")
    command("manifest", "folder", data=False)
    command("verify", "folder", "manifest", data=False)
    return top


def rows_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame | str:
    """What a command shows: rows, or a line of text."""
    if args.command == "manifest":
        return exports.manifest(spark, args.folder)
    if args.command == "verify":
        return exports.verify_manifest(spark.read.parquet(args.manifest), exports.manifest(spark, args.folder))
    tables = load(spark, args)
    if args.command == "snapshot":
        return f"{exports.snapshot(tables['products'], args.path)} products"
    mart = Mart(tables)
    if args.command == "mart":
        return publish.publish(mart, spark, args.root)
    if args.command == "table":
        return getattr(mart, args.name)
    if args.command == "list":
        return dashboard.ordered_list(mart, args.name)
    if args.command == "search":
        return dashboard.search(mart, sort=args.sort, limit=args.limit, offset=args.offset, query=args.query, label=args.label, entity_type=args.entity_type, entity=args.entity)
    if not dashboard.valid_slug(args.slug):
        raise SystemExit("not a slug")
    return dashboard.detail(mart, args.slug)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    shown = rows_of(spark, args)
    if isinstance(shown, str):
        print(shown)
    else:
        shown.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main())
