"""The exploration analyses on typed posting rows (FIXTURES B rows)."""

import math

from pyspark.sql import functions as F

from postlake.operators import frequency
from postlake.plans import analysis, postings

ROWS = [
    # title, company, location, url
    ("\tData Analyst ", "ACME", "Remoto, Córdoba", "u1"),
    ("it's o'neil c++/java", "X", "Córdoba", "u2"),
    (None, None, None, "u3"),
    ("Data Analyst", "ACME", "CABA", "u4"),
    ("Data Analyst", "ACME", "Caballito", "u4"),  # same key as the row above
    ("Analista de datos para la empresa", "Y", "Springfield", "u5"),
]


def postings_df(spark):
    df = spark.createDataFrame(ROWS, "title string, company string, location string, url string")
    df = df.withColumn("source", F.lit("getonboard"))
    stamped = postings.stamp(df, "2024-04-17", F.to_timestamp(F.lit("2024-04-17 10:00:00")))
    return postings.conform(stamped, postings.POSTING_FIELDS + postings.META_FIELDS)


def test_transform_cleans_and_dedups_first(spark):
    out = postings.transform(postings_df(spark)).collect()
    assert len(out) == 5  # u4 twice with the same url+title+company
    by_url = {r.url: r for r in out}
    assert by_url["u1"].title == "Data Analyst" and by_url["u1"].title_lower == "data analyst"
    assert by_url["u2"].title == "It'S O'Neil C++/Java"
    assert by_url["u3"].title is None and by_url["u3"].company is None
    assert by_url["u4"].location == "CABA"  # first by location order among the tie


def test_demand_by_province(spark):
    got = {r.province: (r["count"], r.lat, r.size) for r in analysis.demand_by_province(spark, postings_df(spark)).collect()}
    assert got == {"cordoba": (1, -31.42, 1), "buenos aires": (2, -34.61, 2), "springfield": (1, None, 1)}
    logged = {r.province: r.size for r in analysis.demand_by_province(spark, postings_df(spark), log_size=True).collect()}
    assert math.isclose(logged["buenos aires"], math.log1p(2) * 10)


def test_token_counts_sum_to_token_rows(spark):
    df = postings_df(spark)
    toks = analysis.title_tokens(spark, df)
    total = frequency.value_counts(toks, "token", "count").agg(F.sum("count")).first()[0]
    assert total == toks.count()
    top = [tuple(r) for r in analysis.top_title_tokens(spark, df, k=3).collect()]
    assert top == [("analyst", 3), ("data", 3), ("analista", 1)]  # tie by key; de, para, la are stopwords


def test_prefixes_and_filters(spark):
    df = postings_df(spark)
    got = [tuple(r) for r in analysis.top_title_prefixes(df, n=2, k=2).collect()]
    assert got == [("data analyst", 3, 4, 0.75), ("analista de", 1, 4, 0.25)]
    assert sorted(r.url for r in analysis.keyword_filter(df, "title", "data").collect()) == ["u1", "u4", "u4"]
    assert [r.url for r in analysis.keyword_filter(df, "title", r"^it'?s", regex=True).collect()] == ["u2"]
    assert [r.url for r in analysis.equals_filter(df, "location", "CABA").collect()] == ["u4"]
    assert [r.url for r in analysis.preview(df, ["url"], 2).collect()] == ["u1", "u2"]
    prof = {r.column_name: r.null_count for r in analysis.nulls(df.select("title", "company")).collect()}
    assert prof == {"title": 1, "company": 1}


def test_province_value_counts_and_shape(spark):
    from postlake.operators import profile

    got = {r.province: r["count"] for r in analysis.province_value_counts(postings_df(spark)).collect()}
    assert got == {"remote": 1, "cordoba": 1, "buenos aires": 2, "springfield": 1}
    s = profile.shape(postings_df(spark)).first()
    assert (s.n_rows, s.n_cols) == (6, len(postings.POSTING_FIELDS) + len(postings.META_FIELDS))


def test_select_sources(spark):
    from postlake.sources.pages import select_sources

    df = spark.createDataFrame([(1, "zonajobs"), (2, "indeed"), (3, "other")], "page_id long, source string")
    assert sorted(r.page_id for r in select_sources(df, ["Zonajobs", "nope"]).collect()) == [1]
    assert sorted(r.page_id for r in select_sources(df).collect()) == [1, 2]


def test_dedup_winner_independent_of_partitioning(spark):
    df = postings_df(spark)
    base = sorted((r.job_key, r.location) for r in postings.transform(df).collect())
    for n in (1, 3, 7):
        shuffled = df.repartition(n).orderBy(F.rand(seed=n))
        assert sorted((r.job_key, r.location) for r in postings.transform(shuffled).collect()) == base


def test_dedup_scope_global_vs_per_source(spark):
    df = postings_df(spark)
    other = df.where(F.col("url") == "u1").withColumn("source", F.lit("zonajobs"))
    both = df.unionByName(other)  # the same key in two sources
    per_source = postings.transform(both).count()
    global_scope = postings.transform(both, scope=("ds",)).count()
    assert per_source == 6 and global_scope == 5
