"""Run a whole program: ``spark-submit -m`` style entry point.

    python -m millrace access-log --lines LOG --out DIR
    python -m millrace ratings --ratings CSV --movies CSV --out DIR
    python -m millrace collisions --lines LINES --out DIR
    python -m millrace claims --claims CSV --out DIR

Each result table is written as parquet to a folder of its name under DIR.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from millrace.plans import studies
from millrace.sources import read_csv, read_lines, write_parquet
from millrace.sources.schemas import MOVIES, RATINGS


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="millrace")
    programs = parser.add_subparsers(dest="program", required=True)
    inputs = {
        "access-log": ["lines"],
        "ratings": ["ratings", "movies"],
        "collisions": ["lines"],
        "claims": ["claims"],
    }
    for name, paths in inputs.items():
        program = programs.add_parser(name)
        for path in [*paths, "out"]:
            program.add_argument(f"--{path}", required=True)
        if "lines" in paths:
            program.add_argument("--partitions", type=int, help="spread the lines of gzip files")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"millrace-{args.program}").getOrCreate()
    if args.program == "access-log":
        tables = studies.access_log_study(read_lines(spark, args.lines, args.partitions))
    elif args.program == "ratings":
        tables = studies.rating_study(
            read_csv(spark, args.ratings, RATINGS), read_csv(spark, args.movies, MOVIES)
        )
    elif args.program == "collisions":
        tables = studies.collision_study(read_lines(spark, args.lines, args.partitions))
    else:
        tables = studies.claim_study(read_csv(spark, args.claims))
    for name, table in tables.items():
        write_parquet(table, f"{args.out.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()
