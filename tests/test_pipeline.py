"""Pipeline properties: idempotent reruns, empty reruns, two sources on one
ds, dedup size, recursive scan of a foreign tree."""

import os

import pytest

from postlake.plans import postings
from postlake.sources import sinks
from postlake.sources.scan import scan_parquet_tree, skipped_files
from tests.fixtures import html_pages as H
from pyspark.sql import functions as F

from postlake.functions import html as ph

PAGES = [
    (1, "getonboard", "https://www.getonbrd.com/empleos/1", H.GETONBOARD_FULL),
    (2, "getonboard", "https://www.getonbrd.com/empleos/1", H.GETONBOARD_FULL),  # same key twice
    (3, "computrabajo", "https://www.computrabajo.com.ar/ofertas/1", H.COMPUTRABAJO_FULL),
    (4, "portal_empleo", "https://portalempleo.gob.ar/Oferta/1", H.PORTAL_FULL),
]


def pages_df(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, source string, url string, html string")


def test_run_twice_equals_once_and_sources_survive(spark, tmp_dir):
    raw, proc = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    stats = {}
    first = postings.run(spark, pages_df(spark), "2024-04-17", raw, proc, stats=stats)
    once = sorted(r.job_key for r in first.collect())
    assert stats == {"links": 4, "processed": 4, "blocked": 0, "parsed": 4, "errors": 0, "processed_rows": 3}
    second = postings.run(spark, pages_df(spark), "2024-04-17", raw, proc)
    assert sorted(r.job_key for r in second.collect()) == once
    assert len(once) == 3  # duplicate key removed, three sources kept (G3)
    got = sinks.read_layer(spark, proc, postings.PROCESSED_SCHEMA)
    assert {r.source for r in got.collect()} == {"getonboard", "computrabajo", "portal_empleo"}
    assert dict(got.dtypes)["ds"] == "string"  # G13
    raw_rows = sinks.read_layer(spark, raw, postings.RAW_SCHEMA).count()
    assert raw_rows == 4  # raw keeps the pre-dedup rows
    row = [r for r in got.collect() if r.source == "getonboard"][0]
    assert row.title == "Dataengineer" and row.title_lower == "dataengineer"


def test_empty_rerun_keeps_partition_and_other_days(spark, tmp_dir):
    raw, proc = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    postings.run(spark, pages_df(spark), "2024-04-17", raw, proc)
    postings.run(spark, pages_df(spark), "2024-04-18", raw, proc)
    postings.run(spark, pages_df(spark, []), "2024-04-17", raw, proc)
    got = sinks.read_layer(spark, proc, postings.PROCESSED_SCHEMA)
    counts = {r.ds: r["count"] for r in got.groupBy("ds").count().collect()}
    assert counts == {"2024-04-17": 3, "2024-04-18": 3}


def test_dedup_size_equals_distinct_keys(spark):
    rows = postings.stamp(postings.extract_postings(pages_df(spark)), "2024-04-17")
    distinct = rows.select("job_key").distinct().count()
    assert postings.transform(rows).count() == distinct


def test_scan_foreign_tree_skips_garbage(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x")], "id long, title string")
    b = spark.createDataFrame([(2, "y", "z")], "id long, title string, company string")
    a.write.parquet(os.path.join(tmp_dir, "computrabajo", "2024-04-17"))
    b.write.parquet(os.path.join(tmp_dir, "zonajobs", "2024-04-18"))
    with open(os.path.join(tmp_dir, "zonajobs", "bad.parquet"), "wb") as fh:
        fh.write(b"not parquet at all")
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as fh:
        fh.write("ignored")
    df = scan_parquet_tree(spark, tmp_dir)
    got = sorted((r.id, r.title, r.company) for r in df.collect())
    assert got == [(1, "x", None), (2, "y", "z")]
    given = {os.path.basename(r.path) for r in skipped_files(spark, tmp_dir).collect()}
    assert "bad.parquet" in given  # beside it only the row-less files that Spark's writer left
    assert all(spark.read.parquet(os.path.join(tmp_dir, "*", "*", f)).isEmpty() for f in given - {"bad.parquet"})


def test_scan_reads_files_under_the_root_and_tells_errors_apart(spark, tmp_dir):
    import pandas as pd

    pd.DataFrame({"title": ["root"], "tags": ["one"], "url": ["u0"]}).to_parquet(os.path.join(tmp_dir, "a.parquet"))
    os.makedirs(os.path.join(tmp_dir, "site", "2024-01-01"))
    pd.DataFrame({"title": ["deep"], "tags": [["x", "y"]], "url": ["u1"]}).to_parquet(os.path.join(tmp_dir, "site", "2024-01-01", "b.parquet"))
    for path in (tmp_dir, "file://" + tmp_dir, tmp_dir + "/"):
        got = {r.title: r.tags for r in postings.read_foreign_layer(spark, path).collect()}
        assert got == {"root": ["one"], "deep": ["x", "y"]}
    broken = os.path.join(tmp_dir, "broken")
    os.makedirs(broken)
    with open(os.path.join(broken, "only.parquet"), "wb") as fh:
        fh.write(b"nothing")
    with pytest.raises(ValueError):
        scan_parquet_tree(spark, broken)


def test_scan_empty_path_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        scan_parquet_tree(spark, os.path.join(tmp_dir, "nothing-here"))


def test_crawl_stats(spark):
    from tests.fixtures import html_pages as H2

    rows = [(1, "indeed", "u1", H2.INDEED_BLOCKED), (2, "indeed", "u2", H2.INDEED_JSONLD), (3, "indeed", "u3", None),
            (4, "zonajobs", "u4", "<html>robot</html>")]
    got = {r.source: (r.links, r.processed, r.blocked, r.parsed) for r in postings.crawl_stats(pages_df(spark, rows)).collect()}
    assert got == {"indeed": (3, 3, 2, 1), "zonajobs": (1, 1, 0, 1)}


def test_source_selection():
    from postlake.sources.pages import resolve_sources

    assert resolve_sources(["Portal Empleo", "zonajobs", "zonajobs"]) == ["portal_empleo", "zonajobs"]
    assert resolve_sources(["nope", "indeed"], strict=False) == ["indeed"]
    with pytest.raises(ValueError):
        resolve_sources(["nope"])


def test_cli_run(spark, tmp_dir, capsys):
    import json

    from postlake.__main__ import main

    pages_path = os.path.join(tmp_dir, "pages")
    pages_df(spark).write.parquet(pages_path)
    rc = main(["run", "--pages", pages_path, "--raw", os.path.join(tmp_dir, "raw"),
               "--processed", os.path.join(tmp_dir, "processed"), "--ds", "2024-04-17",
               "--sources", "getonboard,Portal Empleo,unknown"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 0 and out["ds"] == "2024-04-17"
    assert out["links"] == 3 and out["processed_rows"] == 2  # computrabajo not selected; duplicate key removed


def test_read_foreign_layer_with_type_drift(spark, tmp_dir):
    import pandas as pd

    base = os.path.join(tmp_dir, "raw")
    os.makedirs(os.path.join(base, "zonajobs", "2024-04-17"))
    os.makedirs(os.path.join(base, "get_on_board", "2024-04-18"))
    pd.DataFrame({"title": ["A"], "tags": ["Tecnología"], "skills": ["SQL"], "url": ["u1"], "source": ["zonajobs"],
                  "ds": ["2024-04-17"], "scraped_at": ["2024-04-17T10:00:00.123456"], "job_key": ["k1"]}) \
        .to_parquet(os.path.join(base, "zonajobs", "2024-04-17", "jobs_raw.parquet"))
    pd.DataFrame({"title": ["B"], "tags": [["python", "spark"]], "skills": [["SQL"]], "applicants": [12], "url": ["u2"],
                  "source": ["getonboard"], "ds": ["2024-04-18"], "scraped_at": ["2024-04-18T09:00:00"], "job_key": ["k2"]}) \
        .to_parquet(os.path.join(base, "get_on_board", "2024-04-18", "jobs_raw.parquet"))
    with open(os.path.join(base, "get_on_board", "broken.parquet"), "wb") as fh:
        fh.write(b"garbage")
    df = postings.read_foreign_layer(spark, base)
    assert dict(df.dtypes)["tags"] == "array<string>" and dict(df.dtypes)["scraped_at"] == "timestamp"
    got = {r.title: (r.tags, r.skills, r.applicants, r.source) for r in df.collect()}
    assert got == {"A": (["Tecnología"], ["SQL"], None, "zonajobs"), "B": (["python", "spark"], ["SQL"], 12, "getonboard")}


def test_writes_follow_bytes_not_task_counts(spark, tmp_dir):
    import glob

    from pyspark.sql import functions as F

    df = spark.range(0, 40_000, 1, 40).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("2024-01-01").alias("ds"),
        F.when(F.col("id") % 100 < 99, "hot").otherwise("cold").alias("source"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    least = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        sinks.write_layer(df, os.path.join(tmp_dir, "split"))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        sinks.write_layer(df, os.path.join(tmp_dir, "merged"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", least)
    files = lambda where, src: len(glob.glob(os.path.join(tmp_dir, where, "ds=2024-01-01", f"source={src}", "*.parquet")))
    assert files("split", "hot") > 16 and files("merged", "hot") == 1 and files("merged", "cold") == 1
    assert spark.read.parquet(os.path.join(tmp_dir, "split")).count() == 40_000


def test_reruns_keep_the_same_duplicate(spark, tmp_dir):
    page = '<script type="application/ld+json">{"title": "T", "hiringOrganization": {"name": "C"}, "description": "%s"}</script>'
    rows = [(i, "indeed", "https://ar.indeed.com/viewjob?jk=1", page % f"text {i}") for i in (3, 1, 2, 0)]
    seen = []
    for k in range(3):
        base = os.path.join(tmp_dir, str(k))
        out = postings.run(spark, pages_df(spark, rows).repartition(4), "2024-04-17", f"{base}/raw", f"{base}/processed")
        seen.append([tuple(r) for r in out.drop("scraped_at").collect()])
    assert len(seen[0]) == 1 and seen[0] == seen[1] == seen[2]
    assert "text 0" in seen[0][0]


def test_a_run_leaves_other_sources_alone(spark, tmp_dir):
    first = pages_df(spark)
    raw, done = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    postings.run(spark, first, "2024-04-17", raw, done)
    before = {f: os.path.getmtime(f) for f in _files(done)}
    stats = {}
    postings.run(spark, first.where("source = 'getonboard'"), "2024-04-17", raw, done, stats=stats)
    after = {f: os.path.getmtime(f) for f in _files(done)}
    kept = {f for f in before if "source=getonboard" not in f}
    assert kept and all(after[f] == before[f] for f in kept)
    assert stats["processed_rows"] < sum(1 for _ in postings.sinks.read_layer(spark, done, postings.PROCESSED_SCHEMA).collect())


def _files(base):
    return [os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")]


def test_empty_and_failed_pages_count_as_blocked(spark):
    rows = [(1, "http://a.example/en/1", "<h1>T</h1>"), (2, "http://a.example/en/2", ""), (3, "http://a.example/en/3", None), (4, "http://a.example/fr/4", "<p>none</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("section", F.regexp_extract("url", "/([a-z]{2})/", 1))
    got = {r.section: (r.links, r.processed, r.blocked, r.parsed) for r in postings.crawl_stats(pages, ["section"], [], None, ph.first_tag_text("html", "h1").isNotNull()).collect()}
    assert got == {"en": (3, 3, 2, 1), "fr": (1, 1, 0, 0)}
