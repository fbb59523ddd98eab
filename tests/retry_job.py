"""Run the daily job twice — once clean, once with the first attempt of one
task failing — and print both processed results as JSON (used by
test_retry.py in its own process, because it needs a master with retries)."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from postlake.plans import postings  # noqa: E402
from postlake.sources.tables import read_table  # noqa: E402


MARKER = os.path.join(tempfile.mkdtemp(prefix="retry-marker-"), "fired")


def flaky(batches):
    ctx = TaskContext.get()
    for pdf in batches:
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            open(MARKER, "w").close()
            raise RuntimeError("injected executor loss")
        yield pdf


def main():
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    pages = read_table(spark, sys.argv[1], "pages").selectExpr("page_id", "url", "html", "'article' AS source").repartition(4, "page_id")
    out = {}
    for name, src in (("clean", pages), ("retried", pages.mapInPandas(flaky, pages.schema))):
        base = tempfile.mkdtemp(prefix="retry-")
        df = postings.run(spark, src, "2024-01-01", f"{base}/raw", f"{base}/processed")
        out[name] = sorted([r.job_key, r.title, r.location] for r in df.collect())
        out[name + "_raw"] = spark.read.parquet(f"{base}/raw").count()
    out["injected"] = os.path.exists(MARKER)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
