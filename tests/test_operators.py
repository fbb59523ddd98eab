"""Operators: frequencies, top-k shares, profiles, dedup, lookups."""

from pyspark.sql import functions as F

from postlake import functions as pf
from postlake.operators import dedup, frequency, lookup, profile
from postlake.operators.observe import count_stages
from postlake.rules.locations import PROVINCE_COORDS, PROVINCE_RULES, REMOTE_WORDS


def test_value_counts_topk_ties_by_key(spark):
    df = spark.createDataFrame([(w,) for w in "b a c a b d e".split()] + [(None,)], "w string")
    freq = frequency.value_counts(df, "w")
    top = [tuple(r) for r in frequency.top_k(freq, "w", 3).collect()]
    assert top == [("a", 2), ("b", 2), ("c", 1)]


def test_topk_share_sums_to_one(spark):
    df = spark.createDataFrame([(f"k{i % 13}",) for i in range(500)], "w string")
    out = frequency.top_k_share(frequency.value_counts(df, "w"), "w", 10).collect()
    assert len(out) == 10
    assert abs(sum(r.share for r in out) - 1.0) < 1e-9
    assert all(r.top_total == sum(x["count"] for x in out) for r in out)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "x", None), (3, None, None)], "id int, a string, b string")
    got = {r.column_name: (r.null_count, r.non_null_count, r.total_rows, r.total_columns) for r in profile.null_profile(df).collect()}
    assert got == {"id": (0, 3, 3, 3), "a": (2, 1, 3, 3), "b": (2, 1, 3, 3)}


def test_keep_first_deterministic(spark):
    df = spark.createDataFrame([("k1", 3, "c"), ("k1", 1, "a"), ("k2", 2, "b"), (None, 5, "n1"), (None, 6, "n2")], "k string, o int, v string")
    got = sorted((r.k or "", r.v) for r in dedup.keep_first(df, ["k"], ["o"]).collect())
    assert got == [("", "n1"), ("k1", "a"), ("k2", "b")]
    got = sorted(r.v for r in dedup.keep_first(df, ["k"], ["o"], bypass_null_keys=["k"]).collect())
    assert got == ["a", "b", "n1", "n2"]


def test_region_demand_with_coords(spark):
    locs = ["Remoto, Córdoba", "Córdoba Capital", "CABA", "caballito", "Springfield", None, "Rosario"]
    df = spark.createDataFrame([(x,) for x in locs], "location string")
    prov = df.select(pf.normalize_region("location", PROVINCE_RULES, REMOTE_WORDS).alias("province"))
    counts = frequency.group_count(prov.where(F.col("province") != "remote"), "province")
    coords = lookup.small_table(spark, PROVINCE_COORDS, "province string, lat double, lon double")
    got = {r.province: (r["count"], r.lat, r.lon) for r in lookup.attach(counts, coords, "province").collect()}
    assert got == {
        "cordoba": (1, -31.42, -64.18),
        "buenos aires": (2, -34.61, -58.38),
        "springfield": (1, None, None),
        "santa fe": (1, -31.63, -60.70),
    }


def test_rule_join_equals_case_chain(spark):
    locs = ["caba centro", "rosario", "villa mercedes", "nada", None, "córdoba y santa fe"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(locs)], "i int, loc string")
    rules = [(p, cat, kw) for p, (cat, kws) in enumerate(PROVINCE_RULES) for kw in kws]
    prio_rules = [(i, cat, kw) for i, (_, cat, kw) in enumerate(rules)]
    joined = {r.i: r.category for r in lookup.categorize_by_rules(df, "loc", prio_rules).collect()}
    chain = {r.i: r.c for r in df.select("i", pf.normalize_region("loc", PROVINCE_RULES, unmatched="null").alias("c")).collect()}
    assert joined == chain


def test_stopword_anti_join(spark):
    toks = spark.createDataFrame([(w,) for w in ["de", "data", "la", "analyst", "ya que"]], "token string")
    stop = lookup.small_table(spark, [("de",), ("la",), ("ya que",)], "word string")
    assert sorted(r.token for r in lookup.drop_listed(toks, "token", stop).collect()) == ["analyst", "data"]


def test_observe_counts_one_pass(spark):
    df = spark.range(100).withColumn("even", F.col("id") % 2 == 0)
    assert count_stages(df, [("all", None), ("even", F.col("even"))]) == [("all", 100), ("even", 50)]
