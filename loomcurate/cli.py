"""Command line: extract, generate phase1 to phase5, export, stats."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans.phases import Project
from .settings import load
from .sources import web


#: The tables that --input and --output (and their kin) stand for.
PLACES = {
    "phase1": {"input": "posts", "output": "annotations"}, "phase2": {"input": "annotations", "output": "questions"}, "phase3": {"input": "questions", "output": "responses"},
    "phase4": {"questions": "questions", "responses": "responses", "output": "filtered"}, "phase5": {"input": "filtered"},
    "export": {"input": "filtered", "output": "export/training"}, "stats": {"input": "export/meta"},
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomcurate")
    top.add_argument("--settings", help="JSON file of settings")
    top.add_argument("--data-dir")
    commands = top.add_subparsers(dest="command", required=True)
    extract = commands.add_parser("extract")
    extract.add_argument("--opml", required=True, help="file or http address")
    extract.add_argument("--since", help="ISO date; undated posts pass")
    extract.add_argument("--limit", type=int)
    extract.add_argument("--concurrency", type=int, default=10)
    phases = commands.add_parser("generate").add_subparsers(dest="phase", required=True)
    made = {name: (phases if name.startswith("phase") else commands).add_parser(name) for name in PLACES}
    for name, command in made.items():
        for option, table in PLACES[name].items():
            command.add_argument(f"--{option}", help=f"path, in place of the table {table}")
    made["export"].add_argument("--push-to-hub", action="store_true", help="hand the set to the publisher")
    made["export"].add_argument("--hub-repo", help="repository for the publisher")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None, publisher=None) -> int:
    """``publisher(examples, repository)`` serves --push-to-hub."""
    args = parser().parse_args(argv)
    changes = {k: v for k, v in (("data_dir", args.data_dir), ("concurrency", getattr(args, "concurrency", None))) if v is not None}
    spark = spark or SparkSession.builder.appName("loomcurate").getOrCreate()
    project = Project(spark, load(args.settings, **changes))
    for option, table in PLACES.get(getattr(args, "phase", args.command), {}).items():
        if getattr(args, option):
            project.paths[table] = getattr(args, option)
    if args.command == "extract":
        start = F.to_timestamp(F.lit(args.since)) if args.since else None
        project.extract(web.feeds_of(spark, args.opml), start, args.limit).show()
    elif args.command == "generate":
        out = getattr(project, args.phase)()
        if out is not None:
            out.show(truncate=False, vertical=True)
            project.coverage_table().show(200)
    elif args.command == "export":
        if args.push_to_hub and not (publisher and args.hub_repo):
            print("not pushed: that needs --hub-repo and a publisher")
        project.export(publisher if args.push_to_hub else None, args.hub_repo).groupBy("complexity").count().orderBy("complexity").show()
    else:
        found = project.stats()
        print("no export yet") if found is None else found.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
