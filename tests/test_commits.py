"""Both layers under one commit, counters per source, unknown sources, links against pages."""

import os
import subprocess
import sys

import pytest

from postlake.plans import postings
from postlake.sources import frontier, sinks
from tests.test_pipeline import PAGES, pages_df

HERE = os.path.dirname(os.path.abspath(__file__))
DS = "2024-04-17"


def _keys(spark, base, layer):
    schema = postings.RAW_SCHEMA if layer == "raw" else postings.PROCESSED_SCHEMA
    return sorted((r.ds, r.source, r.page_id) for r in sinks.read_committed(spark, base, layer, schema).collect())


def test_a_failed_run_leaves_the_old_pair(spark, tmp_dir, monkeypatch):
    assert _keys(spark, tmp_dir, "raw") == []  # before the first commit
    postings.run_committed(spark, pages_df(spark), DS, tmp_dir)
    before = {layer: _keys(spark, tmp_dir, layer) for layer in ("raw", "processed")}
    assert len(before["raw"]) == 4 and len(before["processed"]) == 3
    write = sinks.write_layer

    def fails_between(df, path, *args):
        if "/processed/" in path:
            raise RuntimeError("lost between the layers")
        write(df, path, *args)

    monkeypatch.setattr(sinks, "write_layer", fails_between)
    with pytest.raises(RuntimeError):
        postings.run_committed(spark, pages_df(spark, PAGES[2:3]), DS, tmp_dir)
    monkeypatch.undo()
    assert {layer: _keys(spark, tmp_dir, layer) for layer in before} == before
    postings.run_committed(spark, pages_df(spark, [(9, *PAGES[2][1:])]), DS, tmp_dir)  # its source only
    assert (DS, "computrabajo", 9) in _keys(spark, tmp_dir, "raw") and (DS, "computrabajo", 3) not in _keys(spark, tmp_dir, "raw")
    assert len(_keys(spark, tmp_dir, "processed")) == 3
    postings.run_committed(spark, pages_df(spark, []), DS, tmp_dir)  # F10
    assert len(_keys(spark, tmp_dir, "processed")) == 3


def test_a_killed_job_leaves_the_old_pair(spark, tmp_dir):
    postings.run_committed(spark, pages_df(spark), DS, tmp_dir)
    before = {layer: _keys(spark, tmp_dir, layer) for layer in ("raw", "processed")}
    job = subprocess.run([sys.executable, os.path.join(HERE, "killed_job.py"), tmp_dir, DS], capture_output=True, text=True, timeout=300, cwd="/tmp")
    assert job.returncode == 9, job.stderr[-2000:]
    assert len(os.listdir(os.path.join(tmp_dir, "raw"))) == 2  # the second version's raw layer is whole
    assert {layer: _keys(spark, tmp_dir, layer) for layer in before} == before


def test_counters_per_source_and_pages_without_one(spark, tmp_dir):
    rows = [*PAGES, (5, "computrabajo", "https://www.computrabajo.com.ar/ofertas/2", None),
            (6, None, "https://elsewhere.example/1", PAGES[0][3]), (7, None, "https://elsewhere.example/2", PAGES[0][3])]
    stats: dict = {}
    raw, processed, counters = (os.path.join(tmp_dir, x) for x in ("raw", "processed", "counters"))
    out = postings.run(spark, pages_df(spark, rows), DS, raw, processed, stats=stats, counters_path=counters)
    assert {r.source for r in out.collect()} == {"getonboard", "computrabajo", "portal_empleo"}
    got = {r.source: tuple(r)[:6] for r in sinks.read_layer(spark, counters, postings.COUNTERS_SCHEMA, ds=DS).collect()}
    assert got == {"getonboard": (2, 2, 0, 2, 0, 1), "computrabajo": (2, 2, 1, 1, 0, 1), "portal_empleo": (1, 1, 0, 1, 0, 1)}
    assert {k: sum(r[i] for r in got.values()) for i, k in enumerate(postings.COUNTERS)} == stats


def test_pages_of_unknown_hosts_are_skipped(spark):
    rows = pages_df(spark, [(1, "x", "https://www.getonbrd.com/empleos/1", PAGES[0][3]), (2, "x", "https://nowhere.example/1", PAGES[0][3]), (3, "x", None, PAGES[0][3])])
    got = postings.extract_postings(rows.drop("source")).select("page_id", "source").collect()
    assert [tuple(r) for r in got] == [(1, "getonboard")]


def test_link_outcomes(spark):
    links = [("indeed", "https://ar.indeed.com/viewjob?jk=a1&from=x"), ("indeed", "https://ar.indeed.com/rc/clk?jk=a1"),
             ("zonajobs", "https://www.zonajobs.com.ar/empleos/1#top"), ("zonajobs", ""), ("zonajobs", None)] + [("zonajobs", "https://z/hot")] * 500
    pages = [(7, "indeed", "https://ar.indeed.com/viewjob?jk=a1"), (3, "indeed", "https://ar.indeed.com/viewjob?tk=2&jk=a1"),
             (5, "zonajobs", "https://z/alone"), (6, "zonajobs", None), (None, "zonajobs", "https://z/hot")]
    out = frontier.link_outcomes(spark.createDataFrame(links, "source string, link string"), spark.createDataFrame(pages, "page_id long, source string, url string"))
    assert {tuple(r) for r in out.collect()} == {
        ("https://ar.indeed.com/viewjob?jk=a1", "fetched", 2, 2, 3),
        ("https://www.zonajobs.com.ar/empleos/1", "missing", 1, 0, None),
        ("https://z/hot", "fetched", 500, 1, None),
        ("https://z/alone", "unlinked", 0, 1, 5),
    }
    empty = spark.createDataFrame([], "source string, link string")
    assert frontier.link_outcomes(empty, spark.createDataFrame([], "page_id long, source string, url string")).count() == 0
