"""The exploration analyses over a postings DataFrame (§3.3 of the blueprint).

Each function takes an already-scoped DataFrame (G14: pick the ``ds`` range
first) and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import functions as pf
from postlake.functions.text import WS
from postlake.operators import frequency, lookup, profile
from postlake.rules.locations import PROVINCE_COORDS, PROVINCE_RULES, REMOTE_WORDS
from postlake.rules.stopwords import STOPWORDS_ES


def with_province(df: DataFrame, location_col: str = "location", out_col: str = "province",
                  rules=PROVINCE_RULES, remote_words=REMOTE_WORDS) -> DataFrame:
    """P8 + X11: add the normalised province column."""
    return df.withColumn(out_col, pf.normalize_region(location_col, rules, remote_words))


def province_value_counts(df: DataFrame, location_col: str = "location") -> DataFrame:
    """A2 over the province column (nulls dropped); order with ``frequency.ordered``."""
    return frequency.value_counts(with_province(df, location_col), "province", "count")


def demand_by_province(spark: SparkSession, df: DataFrame, location_col: str = "location",
                       coords=PROVINCE_COORDS, rules=PROVINCE_RULES, remote_words=REMOTE_WORDS,
                       log_size: bool = False, key_col: str = "province", count_col: str = "count") -> DataFrame:
    """F4 + A1 + J1 + P9: postings per non-remote province with coordinates
    (unknown provinces keep null coordinates) and the marker size — the count,
    or ``log1p(count) * 10`` with ``log_size``."""
    prov = with_province(df.select(location_col), location_col, key_col, rules, remote_words)
    counts = frequency.group_count(prov.where(F.col(key_col) != "remote"), key_col, count_col)
    table = lookup.small_table(spark, coords, f"{key_col} string, lat double, lon double")
    size = F.log1p(count_col) * 10 if log_size else F.col(count_col)
    return lookup.attach(counts, table, key_col).withColumn("size", size)


def title_tokens(spark: SparkSession, df: DataFrame, title_col: str = "title",
                 stopwords: Sequence[str] = STOPWORDS_ES) -> DataFrame:
    """X1 + X4 + X5 + J3: one row per non-stopword title token.

    The split result is exploded directly and empty pieces (from leading or
    trailing whitespace) are dropped by a row filter, which stays in generated
    code (a lambda filter over every word array would not)."""
    words = F.split(pf.remove_punct(F.lower(title_col)), f"{WS}+")
    toks = df.select(F.explode_outer(words).alias("token")).where(F.col("token") != "")
    stop = lookup.small_table(spark, [(w,) for w in stopwords], "word string")
    return lookup.drop_listed(toks, "token", stop)


def top_title_tokens(spark: SparkSession, df: DataFrame, title_col: str = "title", k: int = 10,
                     stopwords: Sequence[str] = STOPWORDS_ES, count_col: str = "count") -> DataFrame:
    """A2 + K1 on the tokens."""
    freq = frequency.value_counts(title_tokens(spark, df, title_col, stopwords), "token", count_col)
    return frequency.top_k(freq, "token", k, count_col)


def top_title_prefixes(df: DataFrame, title_col: str = "title", n: int = 5, k: int = 10,
                       count_col: str = "count") -> DataFrame:
    """X6 + A2 + K1 + A6 + A7: top first-``n``-word prefixes, their total and shares."""
    pref = df.select(pf.first_words(title_col, n).alias("prefix"))
    return frequency.top_k_share(frequency.value_counts(pref, "prefix", count_col), "prefix", k, count_col)


def keyword_filter(df: DataFrame, col: str, pattern: str, regex: bool = False) -> DataFrame:
    """lower-cased contains (or regex search); null never matches."""
    return df.where(keyword_hit(col, pattern, regex))


def keyword_hit(col: str, pattern: str, regex: bool = False) -> Column:
    """F6 as a condition."""
    low = F.lower(col)
    hit = F.regexp_like(low, F.lit(pattern)) if regex else F.contains(low, F.lit(pattern.lower()))
    return F.coalesce(hit, F.lit(False))


def label_hits(df: DataFrame, conditions: Mapping[str, Column], out_col: str = "hit") -> DataFrame:
    """One row per row and condition that holds, named by it; the rows are read once for all."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))
    return df.withColumn(out_col, F.explode_outer(names)).where(F.col(out_col).isNotNull())


def equals_filter(df: DataFrame, col: str, value: str) -> DataFrame:
    """exact, case-sensitive equality."""
    return df.where(F.col(col) == value)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """K2."""
    return frequency.head(df, list(order_by), n)


def nulls(df: DataFrame) -> DataFrame:
    """A3 + A4 + A5 in one pass."""
    return profile.null_profile(df)
