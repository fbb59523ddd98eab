"""Lookups that behave like joins (J1, J2 rule-table forms, J3).

Lookup tables come from local lists, so Spark knows their exact size: the
planner broadcasts one that is under ``spark.sql.autoBroadcastJoinThreshold``
and shuffles a larger one. No hint overrides that choice; only the joins on runs
of characters, whose size the planner can't know, are sort-merge joins by hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A DataFrame over a local list."""
    return spark.createDataFrame(list(rows), schema)


def attach(df: DataFrame, table: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Left equi lookup against a keyed table (missing → nulls)."""
    return df.join(table, on=on, how=how)


def drop_listed(df: DataFrame, col: str, words: DataFrame, word_col: str = "word") -> DataFrame:
    """Remove rows whose ``col`` is in the word list (left anti join)."""
    right = words.withColumnRenamed(word_col, "__w")
    return df.join(right, df[col] == F.col("__w"), "left_anti")


def categorize_by_rules(
    df: DataFrame,
    col: str,
    rules: Sequence[tuple[int, str, str]],
    out_col: str = "category",
) -> DataFrame:
    """J2 in rule-table form: ``rules`` are ``(priority, category, keyword)``; a
    value gets the category of the lowest-priority keyword it contains, null
    when it contains none. One native ``CASE`` over the rules, row-local: no
    join, no shuffle. Empty keywords match nothing."""
    chain = None
    for _, category, keyword in sorted(r for r in rules if r[2]):
        hit = F.contains(F.col(col), F.lit(keyword))
        chain = F.when(hit, F.lit(category)) if chain is None else chain.when(hit, F.lit(category))
    return df.withColumn(out_col, chain if chain is not None else F.lit(None).cast("string"))


#: Characters of the pieces by which keywords are indexed.
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Distinct runs of ``size`` characters, in one pass of a look-ahead."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), 1))


def _hits(values: DataFrame, rules: DataFrame) -> DataFrame:
    """(value, rule) of contained keywords, found by each keyword's rarest run.

    Runs have ``GRAM`` characters, or as many as a shorter keyword has; runs of
    different lengths are different strings, so one join serves them all.

    Spark takes a table of runs for as large as that of the values, each of which
    it holds once per run: left to choose, it may send a hundred times the
    broadcast threshold to the driver. Hence both joins are sort-merge joins.
    """
    pieces = F.concat(*(_grams(F.col("value"), size) for size in range(1, GRAM + 1)))
    held = values.select("value", F.explode(pieces).alias("gram"))
    own = F.when(F.length("keyword") < GRAM, F.array("keyword")).otherwise(_grams(F.col("keyword"), GRAM))
    runs = rules.select("keyword", "rule", F.explode(own).alias("gram"))
    seen = held.groupBy("gram").agg(F.count("*").alias("n"))
    # a run that no value holds rules its keyword out
    rarest = runs.join(seen.hint("merge"), "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    posted = rarest.groupBy("keyword").agg(F.min(F.struct("n", "gram")).alias("least"), F.first("rule").alias("rule"))
    posted = posted.filter("least.n > 0").select(F.col("least.gram").alias("gram"), "keyword", "rule")
    return held.join(posted.hint("merge"), "gram").filter(F.contains("value", "keyword")).select("value", "rule")


def categorize_by_rule_table(df: DataFrame, col: str, rules: DataFrame, out_col: str = "category") -> DataFrame:
    """J2 for rule tables of any size: ``rules`` holds priority, category, keyword.

    The result is that of ``categorize_by_rules`` (lowest priority whose keyword
    the value contains; ties by category, then keyword; null without any), but
    the plan does not grow with the rules. Each distinct value is looked at once:
    its runs of three characters meet, in an equi-join, an index that files every
    keyword under the one of its runs that the fewest values hold, so a frequent
    run carries only the keywords that have nothing rarer. ``contains`` verifies,
    the first rule wins, and the answer is joined back to the rows. Keywords of
    one and two characters go the same way, in the same join, by themselves. Null and
    empty keywords match nothing; ``df`` may not hold a column ``__value``.
    """
    first = F.min(F.struct("priority", "category", "keyword")).alias("rule")
    named = rules.filter("keyword is not null and keyword <> ''").groupBy("keyword").agg(first)
    values = df.select(F.col(col).alias("value")).filter("value is not null").distinct()
    best = _hits(values, named).groupBy("value").agg(F.min("rule").alias("rule"))
    best = best.select(F.col("value").alias("__value"), F.col("rule.category").alias(out_col))
    return df.drop(out_col).join(best, F.col(col) == F.col("__value"), "left").drop("__value")
