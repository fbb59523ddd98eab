"""S1 with type drift inside a folder, and J2 with large rule tables."""

import os
import random

import pytest
from pyspark.sql import types as T

from postlake.operators import lookup
from postlake.sources.scan import footer_schemas, scan_drifting_tree


def test_types_drift_inside_one_folder(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    parts = [
        ([(1, "python", 5)], "id int, skills string, n short"),
        ([(2, ["sql", "r"], None), (3, None, 7)], "id long, skills array<string>, n int"),
        ([(4, "4.5")], "id long, n string"),
        ([(5, None, {"a": 1})], "id long, skills string, extra map<string,int>"),
    ]
    for rows, schema in parts:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/day=1 x")
    with open(f"{base}/bad.parquet", "wb") as fh:
        fh.write(b"nothing of the kind")
    df = scan_drifting_tree(spark, base)
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {"id": "bigint", "skills": "array<string>", "n": "string", "extra": "map<string,int>"}
    got = sorted((r.id, r.skills, r.n, r.extra) for r in df.collect())
    assert got == [(1, ["python"], "5", None), (2, ["sql", "r"], None, None), (3, None, "7", None), (4, None, "4.5", None), (5, None, None, {"a": 1})]
    assert [os.path.basename(r.path) for r in footer_schemas(spark, base).collect() if r["columns"] is None] == ["bad.parquet"]


def test_wanted_schema_and_errors(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    spark.createDataFrame([(1, ["a", "b"])], "id long, tags array<string>").write.parquet(f"{base}/x")
    spark.createDataFrame([(2, "c")], "id long, tags string").write.mode("append").parquet(f"{base}/x")
    wanted = T.StructType([T.StructField("tags", T.StringType()), T.StructField("id", T.StringType()), T.StructField("ds", T.DateType())])
    assert sorted(tuple(r) for r in scan_drifting_tree(spark, base, wanted).collect()) == [('["a","b"]', "1", None), ("c", "2", None)]
    with pytest.raises(FileNotFoundError):
        scan_drifting_tree(spark, os.path.join(tmp_dir, "none"))
    only_bad = os.path.join(tmp_dir, "bad")
    os.makedirs(only_bad)
    with open(f"{only_bad}/a.parquet", "wb") as fh:
        fh.write(b"x")
    with pytest.raises(ValueError):
        scan_drifting_tree(spark, only_bad)


def test_rule_table_equals_the_case(spark):
    rng = random.Random(5)

    def word(low, high):
        return "".join(rng.choice("abc ñ\U0001F600") for _ in range(rng.randint(low, high)))

    values = [word(0, 14) for _ in range(300)] + [None, "", "a\nb", "aaaa"] * 3
    rules = [(rng.randint(0, 40), f"c{rng.randint(0, 9)}", word(0, 6)) for _ in range(120)] + [(1, "line", "a\nb"), (0, "none", "")]
    df = spark.createDataFrame([(i, v, "old") for i, v in enumerate(values)], "i int, v string, category string")
    table = spark.createDataFrame([*rules, (0, "null", None)], "priority int, category string, keyword string")
    got = {r.i: r.category for r in lookup.categorize_by_rule_table(df, "v", table).collect()}
    case = {r.i: r.category for r in lookup.categorize_by_rules(df, "v", rules).collect()}
    assert got == case and len(got) == len(values) and len(set(got.values())) > 3


def test_a_hundred_thousand_rules(spark):
    rules = spark.range(100_000).selectExpr("id AS priority", "concat('c', id % 7) AS category", "concat('key', id, 'x') AS keyword")
    df = spark.createDataFrame([(i, f"some key{i * 37}x and key{i * 37 + 5}x here") for i in range(500)], "i int, v string")
    out = lookup.categorize_by_rule_table(df, "v", rules)
    assert {r.i: r.category for r in out.collect()} == {i: f"c{i * 37 % 7}" for i in range(500)}
    assert len(out._jdf.queryExecution().toString()) < 100_000
    none = lookup.categorize_by_rule_table(df, "v", rules.limit(0))
    assert none.filter("category is not null").count() == 0 and none.count() == 500


def test_rules_are_read_once_for_all_lengths(spark):
    rules = spark.range(60).selectExpr("id AS priority", "concat('c', id) AS category", "substr('abcdefgh', 1 + int(id % 5), 1 + int(id % 4)) AS keyword")
    df = spark.createDataFrame([(0, "xxb"), (1, "zab"), (2, "cdef"), (3, "-"), (4, None)], "i int, v string")
    out = lookup.categorize_by_rule_table(df, "v", rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Generate ") <= 3
    case = lookup.categorize_by_rules(df, "v", [tuple(r) for r in rules.collect()])
    assert sorted(map(str, out.collect())) == sorted(map(str, case.collect()))


def test_runs_are_never_broadcast(spark):
    rng = random.Random(7)
    # the values are smaller than the threshold, their runs larger than may be sent
    values = ["".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(40)) for _ in range(4_000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rules = [(i, f"c{i % 7}", values[i][3 : 4 + i % 5]) for i in range(0, 4_000, 3)]
    table = spark.createDataFrame(rules, "priority int, category string, keyword string")
    limits = {"spark.sql.autoBroadcastJoinThreshold": "2m", "spark.sql.maxBroadcastTableSize": "8m"}
    kept = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        out = lookup.categorize_by_rule_table(df, "v", table)
        got = {r.i: r.category for r in out.collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == {i: next((category for _, category, keyword in rules if keyword in v), None) for i, v in enumerate(values)}
    joins = [line for line in out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n") if "Join " in line and "[gram" in line]
    assert len(joins) == 2 and all("SortMergeJoin" in line for line in joins), joins
