"""Page tables and source selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.rules.extraction import EXTRACTION_RULES

PAGES_SCHEMA = "page_id bigint, url string, html string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A landed page table (``page_id, url, html`` plus optional ``source``)."""
    return spark.read.parquet(path)


def resolve_sources(names: Sequence[str], known: Sequence[str] | None = None, strict: bool = True) -> list[str]:
    """Normalise site names (lower-case, spaces → ``_``). Strict mode
    raises ``ValueError`` for an unknown name before any job starts; lenient
    mode drops it silently (the multi-source extract behaviour)."""
    known_set = set(known if known is not None else EXTRACTION_RULES)
    out = []
    for name in names:
        key = name.lower().replace(" ", "_")
        if key not in known_set:
            if strict:
                raise ValueError(f"unknown source: {name}")
            continue
        if key not in out:
            out.append(key)
    return out


def select_sources(pages: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Keep the pages of the requested known sources (unknown names are
    skipped). The list is tiny, so this is an ``IN`` filter that reaches the
    scan (and prunes ``source`` partitions when the table is partitioned)."""
    wanted = resolve_sources(names if names is not None else list(EXTRACTION_RULES), strict=False)
    return pages.where(F.col("source").isin(wanted))
