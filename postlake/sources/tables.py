"""Table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Session setting: split text-heavy reads into this many partitions.
SPREAD = "spark.postlake.spread"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def spread(df: DataFrame, always: bool = False) -> DataFrame:
    """Round-robin the rows over ``spark.postlake.spread`` partitions, if set.

    A Parquet file with one row group is one task however small the splits are.
    A session that works on such files (the local bench) can ask for a
    round-robin exchange; unset, as on a cluster that reads many row groups,
    nothing is shuffled. ``always`` is for work that is heavy for its bytes: such
    rows are dealt out in any session, over its shuffle partitions or twice its
    cores, whichever is more.
    """
    spark = df.sparkSession
    wanted = spark.conf.get(SPREAD, None)
    if always and not wanted:
        wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(int(wanted)) if wanted else df
