"""Profiles: null counts, shape and column info (A3, A4, A5) in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """A3 + A4 + A5 in long form, one aggregation pass over ``df``.

    Columns: ``column_name``, ``position``, ``data_type``, ``null_count``,
    ``non_null_count``, ``total_rows``, ``total_columns``.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(f"`{c}`")).alias(f"__nn{i}"))
    wide = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(i + 1).alias("position"),
            F.lit(dtypes[c]).alias("data_type"),
            F.col(f"__nn{i}").alias("non_null_count"),
        )
        for i, c in enumerate(cols)
    ]
    long = wide.select(F.col("__rows"), F.explode(F.array(*entries)).alias("e"))
    return long.select(
        F.col("e.column_name").alias("column_name"),
        F.col("e.position").alias("position"),
        F.col("e.data_type").alias("data_type"),
        (F.col("__rows") - F.col("e.non_null_count")).alias("null_count"),
        F.col("e.non_null_count").alias("non_null_count"),
        F.col("__rows").alias("total_rows"),
        F.lit(len(cols)).alias("total_columns"),
    )


def shape(df: DataFrame) -> DataFrame:
    """A4 as a one-row DataFrame (``n_rows``, ``n_cols``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))
