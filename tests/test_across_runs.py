"""A8 across runs: rows that an earlier run stored are dropped."""

import os

from pyspark.sql import functions as F

from postlake.operators import dedup
from postlake.plans import postings


def test_drop_stored_is_exact(spark, monkeypatch):
    stored = spark.range(0, 40_000).selectExpr("id % 3 AS s", "concat('k', id * 2) AS k", "id AS other")
    new = spark.range(0, 3000).selectExpr("id % 3 AS s", "concat('k', id) AS k", "id AS n")
    expected = {(i % 3, f"k{i}") for i in range(3000)} - {(i % 3, f"k{2 * i}") for i in range(40_000)}
    for bits in (8, 0):  # a filter of one bitmap for all keys lets more through, never less
        monkeypatch.setattr(dedup, "BITS_A_KEY", bits)
        got = dedup.drop_stored(new, stored, ["s", "k"])
        assert {(r.s, r.k) for r in got.collect()} == expected and got.columns == new.columns
    hashed = F.xxhash64("s", "k")
    near = dedup.possibly_in(stored, hashed, 4, dedup.key_bitmaps(new, hashed, 4))
    assert near.count() < 6000  # 3,000 keys in 131,072 bits


def test_null_keys_and_empty_sides(spark):
    new = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), ("b", 4)], "k string, n int")
    stored = spark.createDataFrame([(None,), ("b",)], "k string")
    assert sorted(r.n for r in dedup.drop_stored(new, stored, ["k"]).collect()) == [2, 3]
    assert dedup.drop_stored(new, stored.limit(0), ["k"]).count() == 4
    assert dedup.drop_stored(new.limit(0), stored, ["k"]).count() == 0


def test_second_day_drops_the_first_days_postings(spark, tmp_dir):
    raw, processed = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    rows = spark.createDataFrame([("indeed", "u1", "a"), ("indeed", "u2", "b"), ("zonajobs", "u1", "a")], "source string, url string, title string")

    def day(ds, df, days):
        stamped = postings.transform(postings.stamp(df.withColumn("company", F.lit("c")), ds)).select(*postings.PROCESSED_SCHEMA.fieldNames())
        kept = postings.drop_seen(spark, stamped, processed, ds, days)
        postings.sinks.write_layer(kept, processed)
        back = postings.sinks.read_layer(spark, processed, postings.PROCESSED_SCHEMA, ds=ds)
        return sorted((r.source, r.url) for r in back.collect())

    first = [("indeed", "u1"), ("indeed", "u2"), ("zonajobs", "u1")]
    more = rows.unionByName(spark.createDataFrame([("indeed", "u3", "d"), ("zonajobs", "u2", "b")], rows.schema))
    assert day("2024-04-01", rows, 7) == first
    assert day("2024-04-02", more, 7) == [("indeed", "u3"), ("zonajobs", "u2")]
    assert day("2024-04-02", more, 7) == [("indeed", "u3"), ("zonajobs", "u2")]  # a rerun
    assert day("2024-04-01", rows, 7) == first  # an earlier day does not see later ones
    assert day("2024-04-20", rows, 7) == first  # out of scope
