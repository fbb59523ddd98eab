"""Command line: one daily run.

    python -m postlake run --pages PATH --raw PATH --processed PATH [--ds YYYY-MM-DD] [--sources a,b]

Uses the active cluster session (``spark-submit``); without one, a local
session. Prints the run counters as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from postlake.session import local_session

    return local_session()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="postlake")
    sub = parser.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="extract → raw → transform → processed for one ds")
    run.add_argument("--pages", required=True)
    run.add_argument("--raw", required=True)
    run.add_argument("--processed", required=True)
    run.add_argument("--ds", help="run date (default: today, yyyy-MM-dd)")
    run.add_argument("--sources", help="comma-separated site keys (unknown ones are skipped)")
    args = parser.parse_args(argv)

    spark = _session()
    from postlake.functions.text import today_ds
    from postlake.plans import postings
    from postlake.sources.pages import read_pages, select_sources
    from postlake.sources.tables import spread

    pages = read_pages(spark, args.pages)
    if "source" not in pages.columns:
        pages = pages.withColumn("source", postings.source_of(F.col("url")))
    if args.sources:
        pages = select_sources(pages, [s.strip() for s in args.sources.split(",") if s.strip()])
    pages = spread(pages.select(*[c for c in ("page_id", "source", "url", "html") if c in pages.columns]))
    ds = args.ds or spark.range(1).select(today_ds()).first()[0]
    stats: dict = {}
    postings.run(spark, pages, ds, args.raw, args.processed, stats=stats)
    print(json.dumps({"ds": ds, **stats}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
