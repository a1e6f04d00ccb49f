"""Command line: ``python -m convograph list``, ``run QUERY DATA OUT``, ``types DATA COLUMN`` and ``check FILE``."""

from __future__ import annotations

import argparse
import json
import sys

from convograph import providers


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="convograph")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    run = commands.add_parser("run", help="write a query's rows as Parquet")
    for name in ("query", "data", "out"):
        run.add_argument(name)
    types = commands.add_parser("types", help="how often each value of a column of a Parquet table occurs")
    for name in ("table", "column"):
        types.add_argument(name)
    commands.add_parser("check", help="read a settings file").add_argument("file")
    a = parser.parse_args(argv)
    if a.command == "check":
        try:
            print(json.dumps(providers.settings(a.file), sort_keys=True))
        except (OSError, ValueError) as e:
            print(e, file=sys.stderr)
            return 1
        return 0

    from convograph.plans import catalog

    queries = catalog.queries()
    if a.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    if a.command == "run" and a.query not in queries:
        print(f"no query {a.query}", file=sys.stderr)
        return 1

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("convograph").getOrCreate()
    if a.command == "run":
        queries[a.query](spark, a.data).write.mode("errorifexists").parquet(a.out)
    else:
        for value, n in spark.read.parquet(a.table).groupBy(a.column).count().orderBy("count", ascending=False).toLocalIterator():
            print(f"{n}\t{value}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
