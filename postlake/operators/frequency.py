"""Group counts, value counts, top-k and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_count(df: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """A1: rows per non-null key (partial + final hash aggregate)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_col))


def value_counts(df: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """A2: like ``group_count``; order with ``top_k`` or ``ordered`` when needed."""
    return group_count(df, key, count_col)


def ordered(freq: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """Count descending, ties by key ascending."""
    return freq.orderBy(F.col(count_col).desc(), F.col(key).asc())


def top_k(freq: DataFrame, key: str, k: int = 10, count_col: str = "count") -> DataFrame:
    """K1: the ``k`` most frequent keys (ties by key) — a TakeOrderedAndProject,
    so each partition keeps only ``k`` rows before anything moves."""
    return ordered(freq, key, count_col).limit(k)


def top_k_share(
    freq: DataFrame,
    key: str,
    k: int = 10,
    count_col: str = "count",
    share_col: str = "share",
    total_col: str = "top_total",
) -> DataFrame:
    """A6 + A7: top-k rows with their total and each row's share of it.

    The window without partitioning runs after the limit, on at most ``k``
    rows, so the single-partition exchange it needs carries ``k`` rows only.
    """
    top = top_k(freq, key, k, count_col)
    w = Window.partitionBy()
    total = F.sum(F.col(count_col)).over(w)
    return top.select(
        key,
        count_col,
        total.cast("bigint").alias(total_col),
        (F.col(count_col) / total).alias(share_col),
    )


def head(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """K2: the first ``n`` rows by a stable order."""
    return df.orderBy(*order_by).limit(n)
