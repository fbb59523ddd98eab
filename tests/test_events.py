"""The event array against the tree on every fixture page, rule by rule."""

import pytest

from postlake.operators.events import extract_events, parse_selector, split_rules
from postlake.operators.extract import extract_inputs
from postlake.plans import postings
from postlake.rules.extraction import EXTRACTION_RULES, REPAIR_SOURCES
from tests.fixtures import html_pages as H

NATIVE = {s: split_rules(r)[0] for s, r in EXTRACTION_RULES.items()}
PAGES = [
    ("getonboard", H.GETONBOARD_FULL), ("getonboard", H.GETONBOARD_MISSING), ("getonboard", H.GETONBOARD_EMPTY_LOCATION),
    ("zonajobs", H.ZONAJOBS_FULL), ("zonajobs", H.ZONAJOBS_MISSING), ("zonajobs", H.ZONAJOBS_MALFORMED),
    ("indeed", H.INDEED_JSONLD), ("indeed", H.INDEED_NO_JSONLD), ("indeed", H.INDEED_NOTHING),
    ("computrabajo", H.COMPUTRABAJO_FULL), ("computrabajo", H.COMPUTRABAJO_NO_SEP), ("computrabajo", H.COMPUTRABAJO_BLANK_DESC),
    ("portal_empleo", H.PORTAL_FULL), ("portal_empleo", H.PORTAL_TWO_AVAILABILITY), ("portal_empleo", H.PORTAL_MISSING),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k, s, f"https://x/{k}", h) for k, (s, h) in enumerate(PAGES)]
    rows += [(100, "nosuch", "u", "<p>x</p>"), (101, "indeed", "u", "no tags"), (102, "zonajobs", "u", "<h1>A</h1><a href='x"), (103, "zonajobs", "u", None)]
    df = spark.createDataFrame(rows, "page_id long, source string, url string, html string")
    return {r.page_id: r for r in extract_events(df, NATIVE, repair_sources=sorted(REPAIR_SOURCES)).collect()}


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_equals_the_tree(found, k):
    source, html = PAGES[k]
    want = extract_inputs(html, NATIVE[source], repair=source in REPAIR_SOURCES)
    want.pop("page_text", None)
    got = {name: list(v) for name, v in found[k].inputs.items()}
    assert {n: v for n, v in got.items() if v} == {n: v for n, v in want.items() if v}
    assert found[k].parse_ok


def test_failures_are_values(found):
    assert not found[100].parse_ok and found[100].parse_error == "no rules for source nosuch" and found[100].inputs is None
    assert found[101].parse_error == "no markup" and found[102].parse_error == "ends inside a tag"
    assert found[103].parse_error == "no markup" or not found[103].parse_ok


def test_selectors():
    assert parse_selector("a[href*='/x, y/'], ul.a.b li") == [[("a", "[href*='/x, y/']")], [("ul", ".a.b"), ("li", "")]]
    for bad in ("div > p", "p:nth-of-type(2)", "svg ~ text", ""):
        with pytest.raises(ValueError):
            parse_selector(bad)


def test_rules_that_need_the_tree():
    rest = {s: [(n, x) for n, _, x, _ in split_rules(r)[1]] for s, r in EXTRACTION_RULES.items()}
    assert {s for s, r in rest.items() if r} == {"zonajobs", "portal_empleo", "article"}


def test_postings_without_python(spark):
    df = spark.createDataFrame([(1, "portal_empleo", "https://portalempleo.gob.ar/Oferta/1", H.PORTAL_FULL)], "page_id long, source string, url string, html string")
    out = postings.extract_postings(df, NATIVE, extractor=extract_events)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    r = out.collect()[0]
    assert (r.title, r.job_type, r.experience_level, r.skills) == ("operario de depósito", "Tiempo completo", "No", ["Secundario completo"])
    assert r.description_raw == "Carga y descarga.\nControl de stock."
