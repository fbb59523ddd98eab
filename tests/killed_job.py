"""A daily run whose process ends at once when the processed layer is to be
written (used by test_commits.py in its own process)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from postlake.plans import postings  # noqa: E402
from postlake.sources import sinks  # noqa: E402
from tests.test_pipeline import PAGES, pages_df  # noqa: E402

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
write = sinks.write_layer


def dies_between(df, path, *args):
    if "/processed/" in path:
        os._exit(9)
    write(df, path, *args)


sinks.write_layer = dies_between
postings.run_committed(spark, pages_df(spark, PAGES[:3]), sys.argv[2], sys.argv[1])
