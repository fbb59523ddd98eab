"""Layered Parquet sinks (S3, S4) with dynamic partition overwrite.

A rerun for the same ``(ds, source)`` replaces exactly those partitions and
leaves every other one alone; an empty rerun changes nothing (F10). Rows are
rebalanced on the partition columns before the write: AQE merges small
partitions and splits a hot ``(ds, source)`` by bytes
(``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so a day of any size is
written by as many tasks as its bytes need, in files of about that size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLS = ("ds", "source")
COMMITS_SCHEMA = "ds string, source string, version string"


def write_layer(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = PARTITION_COLS,
) -> None:
    """Dynamic-overwrite write of rows rebalanced on the partition columns."""
    (
        df.hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_layer(spark: SparkSession, path: str, schema: T.StructType, **filters) -> DataFrame:
    """Read a layer back with an explicit schema, so ``ds`` stays a string
    (G13); keyword filters such as ``ds="2024-01-01"`` prune partitions."""
    df = spark.read.schema(schema).parquet(path)
    for col, value in filters.items():
        df = df.where(df[col] == value)
    return df


# ------------------------------------------- several layers under one commit
def new_version() -> str:
    """A version name; later ones sort behind earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def version_path(base_path: str, layer: str, version: str) -> str:
    """Folder of one layer's rows of one version; unseen until it is committed."""
    return f"{base_path}/{layer}/version={version}"


def commit(spark: SparkSession, base_path: str, version: str, ds: str, sources: Sequence[str]) -> None:
    """Make the staged ``version`` the current one of ``ds`` and ``sources``, in
    all layers at once: one file of a few rows, which appears whole or not at
    all. No source (an empty run) commits nothing (F10)."""
    if sources:
        rows = spark.createDataFrame([(ds, s, version) for s in sorted(sources)], COMMITS_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(f"{base_path}/commits")


def read_committed(spark: SparkSession, base_path: str, layer: str, schema: T.StructType, **filters) -> DataFrame:
    """The current rows of a layer: of each (ds, source) the version committed
    last. Staged rows without a commit, and replaced ones, are not seen; before
    the first commit the layer is empty. Filters on ``ds`` or ``source`` prune
    partitions and bound the commits that are read."""
    try:
        commits = spark.read.schema(COMMITS_SCHEMA).parquet(f"{base_path}/commits")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())])).parquet(f"{base_path}/{layer}")
    for col, value in filters.items():
        rows = rows.where(F.col(col) == value)
        commits = commits.where(F.col(col) == value) if col in PARTITION_COLS else commits
    current = commits.groupBy(*PARTITION_COLS).agg(F.max("version").alias("version"))
    return rows.join(current, [*PARTITION_COLS, "version"], "left_semi").select(*schema.fieldNames())
