"""Reports, checks and exports from the command line: python -m sievework.cli report NAME FOLDER [--csv FILE], catalog, validate FOLDER, export LEDGER FOLDER, inspect LEDGER CANDIDATE [history]."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sievework import catalogue
from sievework.plans.documents import review_gate
from sievework.session import session
from sievework.sources import sinks, statistics, tables


def inspected(spark: SparkSession, ledger: str, candidate: str, part: str = "summary") -> dict | list | None:
    """A candidate with its attempts and reviews, or its events, in order; None if there is no such candidate. A candidate's rows are bounded by its call limits."""
    own = lambda name: [r.asDict() for r in tables.ledger(spark, ledger, name).where(F.col("candidate_id") == candidate).orderBy("id").collect()]
    if part == "history":
        return own("events")
    rows = tables.ledger(spark, ledger, "candidates").where(F.col("candidate_id") == candidate).limit(1).collect()
    return {"candidate": rows[0].asDict(), "stages": own("stage_attempts"), "reviews": own("reviews")} if rows else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sievework", description=__doc__)
    sub = p.add_subparsers(dest="task", required=True)
    sub.add_parser("catalog", help="names of all queries")
    report = sub.add_parser("report", help="run a query over a folder of tables")
    report.add_argument("name", choices=sorted(catalogue.QUERIES))
    report.add_argument("folder")
    report.add_argument("--rows", type=int, default=50, help="rows that are printed")
    report.add_argument("--csv", help="write the whole report to one CSV file")
    report.add_argument("--parquet", help="write the whole report as Parquet")
    validate = sub.add_parser("validate", help="how many documents pass the review gate")
    validate.add_argument("folder")
    stats = sub.add_parser("stats", help="write all reports of a folder as Parquet")
    stats.add_argument("folder")
    stats.add_argument("out")
    export = sub.add_parser("export", help="write the statistics of a ledger: a summary and its reports and tables as CSV")
    export.add_argument("ledger")
    export.add_argument("out")
    inspect = sub.add_parser("inspect", help="what a ledger has of a candidate, as JSON")
    inspect.add_argument("ledger")
    inspect.add_argument("candidate")
    inspect.add_argument("part", nargs="?", choices=("summary", "history"), default="summary")
    a = p.parse_args(argv)
    if a.task == "catalog":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    spark = session()
    if a.task == "report":
        df = catalogue.QUERIES[a.name](spark, a.folder)
        if a.csv:
            Path(a.csv).write_bytes(sinks.report_csv(df))
        elif a.parquet:
            df.write.mode("overwrite").parquet(a.parquet)
        else:
            print(sinks.text_table(df.limit(a.rows)))
    elif a.task == "validate":
        print(sinks.text_table(review_gate(spark, a.folder).groupBy("passed").count()))
    elif a.task == "inspect":
        found = inspected(spark, a.ledger, a.candidate, a.part)
        if found is None:
            print(f"CANDIDATE_NOT_FOUND {a.candidate}", file=sys.stderr)
            return 1
        print(json.dumps(found, ensure_ascii=False, indent=2))
    elif a.task == "export":
        statistics.export(spark, a.ledger, a.out)
    else:
        sinks.write_all({k: f(spark, a.folder) for k, f in catalogue.QUERIES.items()}, a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
