"""The cost of reading landed pages: rows are dealt out, and a search is worked out once."""

from pyspark.sql import functions as F

from postlake.operators import flat
from postlake.operators.events import extract_events, split_rules
from postlake.plans import site_pages
from postlake.rules.extraction import EXTRACTION_RULES
from postlake.sources.tables import spread


def test_rows_of_one_file_are_dealt_out(spark, tmp_dir):
    spark.range(500).selectExpr("id AS k").coalesce(1).write.parquet(f"{tmp_dir}/t.parquet")
    pages = site_pages.land(spark, tmp_dir, "t", "k", "zonajobs", "https://x/", F.concat(F.lit("<p>"), F.col("k").cast("string"), F.lit("</p>")))
    assert len(pages.inputFiles()) >= 8 and pages.count() == 500
    assert pages.select("page_id").distinct().count() == 500


def test_search_behind_each_anchor_is_worked_out_once(spark):
    html = "<html><body>" + '<i name="icon-office"></i><p>a</p><i name="icon-office"></i><p>b</p>' + "</body></html>"
    df = spark.createDataFrame([(1, "zonajobs", "u", html)], "page_id long, source string, url string, html string")
    native, _ = split_rules(EXTRACTION_RULES["zonajobs"])
    each = [r for r in native if r[3].get("each")]
    out = extract_events(df, {"zonajobs": each}, repair_sources=["zonajobs"])
    assert out.collect()[0].inputs["modality_text"] == ["b"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == len(each)


def test_heavy_work_is_dealt_out_without_the_setting(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one, always=True).rdd.getNumPartitions() >= 8 and spread(one).rdd.getNumPartitions() == 1


def test_a_single_value_is_worked_out_once(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    out = df.select(flat._one(F.upper("v")).alias("l"))
    assert [r.l for r in out.collect()] == [["A"], []]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("upper(") == 1
