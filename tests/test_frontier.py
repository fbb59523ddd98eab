"""Crawl frontier (S9) and detail links from listing pages (H8 rule form)."""

from postlake.rules.sites import ALL_LISTING_TEMPLATES, DEFAULT_MAX_PAGES, SITE_MAX_PAGES
from postlake.sources import frontier
from tests.fixtures import html_pages as H


def test_detail_links_per_source(spark):
    pages = [
        (1, "getonboard", "https://www.getonbrd.com/empleos/", H.LISTING_GETONBOARD),
        (2, "zonajobs", "https://www.zonajobs.com.ar/empleos.html?page=1", H.LISTING_ZONAJOBS),
        (3, "indeed", "https://ar.indeed.com/jobs?q=data", H.LISTING_INDEED),
        (4, "portal_empleo", "https://portalempleo.gob.ar/OfertasLaborales?page-number=1", H.LISTING_PORTAL),
        (5, "computrabajo", "https://www.computrabajo.com.ar/trabajo-de-data/?p=1", H.LISTING_COMPUTRABAJO),
    ]
    df = spark.createDataFrame(pages, "page_id long, source string, url string, html string")
    got = sorted(tuple(r) for r in frontier.detail_links(df).collect())
    assert got == [
        ("computrabajo", "https://www.computrabajo.com.ar/ofertas-de-trabajo/1"),
        ("getonboard", "https://www.getonbrd.com/empleos/data-engineer-acme"),
        ("getonboard", "https://www.getonbrd.com/empleos/x"),
        ("indeed", "https://ar.indeed.com/viewjob?jk=abc123"),
        ("indeed", "https://ar.indeed.com/viewjob?jk=zz9"),
        ("portal_empleo", "https://portalempleo.gob.ar/Oferta/7"),
        ("zonajobs", "https://www.zonajobs.com.ar/empleos/1.html"),
    ]


def test_listing_urls(spark):
    searches = spark.createDataFrame([(1, "data analyst")], "id int, q string")
    two = dict.fromkeys(SITE_MAX_PAGES, 2)
    rows = frontier.listing_urls(searches, "q", "Buenos Aires", two).collect()
    urls = {(r.source, r.page): r.url for r in rows}
    assert urls[("indeed", 2)] == "https://ar.indeed.com/jobs?q=data+analyst&l=Buenos+Aires&start=10"
    assert urls[("computrabajo", 1)] == "https://www.computrabajo.com.ar/trabajo-de-data-analyst/?p=1&q=Buenos+Aires"
    assert urls[("zonajobs", 2)] == "https://www.zonajobs.com.ar/empleos-busqueda-data-analyst.html?page=2"
    assert urls[("getonboard", 1)] == "https://www.getonbrd.com/empleos-data-analyst" and ("getonboard", 2) not in urls
    all_rows = frontier.listing_urls(searches, "q", "Buenos Aires", two, list(ALL_LISTING_TEMPLATES)).collect()
    all_urls = {(r.source, r.page): r.url for r in all_rows}
    assert all_urls[("getonboard", 1)] == "https://www.getonbrd.com/empleos/"
    assert all_urls[("portal_empleo", 2)] == "https://portalempleo.gob.ar/OfertasLaborales?page-number=2"
    assert all_urls[("indeed", 1)] == "https://ar.indeed.com/jobs?q=data+analyst&l=Buenos+Aires&start=0"
    assert len(all_rows) == 1 + 2 * 4


def test_each_site_has_its_own_page_limit(spark):
    searches = spark.createDataFrame([("x",)], "q string")
    pages = {r.source: r["max(page)"] for r in frontier.listing_urls(searches, "q", "AR").groupBy("source").max("page").collect()}
    assert pages == {"getonboard": 1, "zonajobs": 31, "portal_empleo": 31, "computrabajo": 31, "indeed": 31}
    some = frontier.listing_urls(searches, "q", "AR", {"indeed": 3})
    pages = {r.source: r["max(page)"] for r in some.groupBy("source").max("page").collect()}
    assert pages["indeed"] == 3 and pages["zonajobs"] == DEFAULT_MAX_PAGES


def test_placeholders_in_the_search_text_stay_text(spark):
    searches = spark.createDataFrame([("a {p} {loc}",)], "q string")
    urls = {(r.source, r.page): r.url for r in frontier.listing_urls(searches, "q", "AR").collect()}
    assert urls["indeed", 1] == "https://ar.indeed.com/jobs?q=a+{p}+{loc}&l=AR&start=0"
