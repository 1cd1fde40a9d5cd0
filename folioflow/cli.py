"""Command line: a catalogue to a graph."""

from __future__ import annotations

import argparse
import sys

from .plans import pipelines
from .session import session

FORMS = ("turtle", "ntriples")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folioflow", description="Convert a library catalogue (CSV, or CSV in a zip archive) to a graph.")
    p.add_argument("-i", "--input", required=True, help="catalogue file")
    p.add_argument("-o", "--output", required=True, help="folder to write the graph to")
    p.add_argument("-f", "--format", choices=FORMS, default="turtle", help="form of the graph (default: %(default)s)")
    p.add_argument("--merge", choices=("first", "collect"), default="collect", help="how rows of one entity merge (default: %(default)s)")
    p.add_argument("--lists", choices=("multi", "list"), default="multi", help="array fields as single statements or as ordered lists")
    p.add_argument("--strict", action="store_true", help="fail at the first bad required value")
    p.add_argument("--single", action="store_true", help="write one file, by one task")
    p.add_argument("--master", help="Spark master, where the environment names none")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session("folioflow", args.master)
    pipelines.convert_catalogue(spark, args.input, args.output, args.format, args.single, merge_mode=args.merge, list_mode=args.lists, strict=args.strict)
    print(f"Wrote {args.output}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
