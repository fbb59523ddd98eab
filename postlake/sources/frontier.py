"""Crawl-frontier rows — listing URLs per search row, source and page."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake import functions as pf
from postlake.rules.extraction import CANONICAL_PARAM, LISTING_RULES
from postlake.rules.sites import ALL_LISTING_TEMPLATES, DEFAULT_MAX_PAGES, LISTING_TEMPLATES, SITE_BASE_URLS, SITE_MAX_PAGES


def _fill(template: str, query: Column, location: Column, page: Column) -> Column:
    """The URL as one ``concat``: placeholders inside the user's own text stay text."""
    value = {
        "{dash}": F.replace(query, F.lit(" "), F.lit("-")),
        "{slug}": F.replace(F.lower(query), F.lit(" "), F.lit("-")),
        "{plus}": F.replace(query, F.lit(" "), F.lit("+")),
        "{loc}": F.replace(location, F.lit(" "), F.lit("+")),
        "{p}": page.cast("string"),
        "{start}": ((page - 1) * 10).cast("string"),
    }
    parts = [x for x in re.split("(" + "|".join(map(re.escape, value)) + ")", template) if x]
    return F.concat(*[value[x] if x in value else F.lit(x) for x in parts])


def listing_urls(
    searches: DataFrame,
    query_col: str,
    location: str,
    max_pages: Mapping[str, int] = SITE_MAX_PAGES,
    all_listing_sources=(),
) -> DataFrame:
    """One row per (search row, source, page), pages 1 to the site's own limit
    (``DEFAULT_MAX_PAGES`` for a site without one; 1 where the template has no
    page). Sources and pages are literal arrays exploded per row — a generate,
    not a join. Sources named in ``all_listing_sources`` use their
    list-everything template (the search text is then not part of the URL, G9)."""
    templates = {
        src: (ALL_LISTING_TEMPLATES[src] if src in all_listing_sources else tpl).replace("{base}", SITE_BASE_URLS[src])
        for src, tpl in LISTING_TEMPLATES.items()
    }

    def pages(src: str) -> int:
        paged = "{p}" in templates[src] or "{start}" in templates[src]
        return max_pages.get(src, DEFAULT_MAX_PAGES) if paged else 1

    sources = F.array(*[F.struct(F.lit(src).alias("source"), F.lit(pages(src)).alias("pages")) for src in templates])
    with_src = searches.withColumn("__s", F.explode(sources))
    with_page = with_src.withColumn("page", F.explode(F.sequence(F.lit(1), F.col("__s.pages"))))
    url = None
    for src, tpl in templates.items():
        filled = _fill(tpl, F.col(query_col), F.lit(location), F.col("page"))
        here = F.col("__s.source") == src
        url = F.when(here, filled) if url is None else url.when(here, filled)
    return with_page.withColumn("source", F.col("__s.source")).withColumn("url", url).drop("__s")


def link_key(url: Column, source: Column) -> Column:
    """The URL under which a link and a fetched page meet — without
    fragment, rebuilt from the id where the site names its pages by one
    parameter (tracking parameters go). Null for an empty URL."""
    key = F.regexp_replace(url, "#.*$", "")
    for src, param in CANONICAL_PARAM.items():
        key = F.when(source == src, pf.canonical_by_param(key, SITE_BASE_URLS[src], param)).otherwise(key)
    return F.nullif(key, F.lit(""))


def link_outcomes(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Every linked or fetched URL once, with its outcome.

    ``links`` holds ``(source, link)`` as found (repeats count), ``pages``
    ``(page_id, source, url)``. The outcome is ``fetched`` (linked and there),
    ``missing`` (linked, no page) or ``unlinked`` (a page no link names); with
    it the number of links and pages and the smallest page id. Rows without a
    URL are left out. Both sides meet in one aggregate by key, which is the full
    outer join of their per-key totals: one shuffle of partial sums, so a URL
    that a third of all pages link to is a handful of rows in it.
    """
    wanted = links.select(
        link_key(F.col("link"), F.col("source")).alias("link"), F.lit(1).alias("to"), F.lit(0).alias("at"), F.lit(None).cast("long").alias("page_id")
    )
    there = pages.select(link_key(F.col("url"), F.col("source")).alias("link"), F.lit(0).alias("to"), F.lit(1).alias("at"), F.col("page_id").cast("long"))
    totals = wanted.unionByName(there).where("link is not null").groupBy("link").agg(
        F.sum("to").alias("n_links"), F.sum("at").alias("n_pages"), F.min("page_id").alias("page_id")
    )
    outcome = F.when(F.col("n_pages") == 0, "missing").when(F.col("n_links") == 0, "unlinked").otherwise("fetched")
    return totals.select("link", outcome.alias("outcome"), "n_links", "n_pages", "page_id")


def _site_base(source: Column, page_url: Column) -> Column:
    expr = None
    for src, base in SITE_BASE_URLS.items():
        cond = source == src
        expr = F.when(cond, F.lit(base)) if expr is None else expr.when(cond, F.lit(base))
    return expr.otherwise(pf.origin(page_url))


def detail_links(listing_pages: DataFrame, rules=LISTING_RULES, extractor: Callable | None = None) -> DataFrame:
    """H8 + X15 + X16 + F8 + A9: distinct detail-page URLs per source from
    listing pages ``(page_id, source, url, html)``.

    The link selectors run in the extraction job (or in ``extractor``, see
    ``operators.flat``); the rest is native:
    empty hrefs are dropped, relative ones joined to the site's base URL (or
    the listing page's origin for unknown sites), id-parameter URLs
    canonicalised, and duplicates removed with a map-side-combined distinct.
    """
    from postlake.operators.extract import extract_pages

    found = (extractor or extract_pages)(listing_pages, rules)
    hrefs = found.select(
        "source", "url", F.explode_outer(F.try_element_at("inputs", F.lit("links"))).alias("href")
    ).where(F.col("href").isNotNull() & (F.col("href") != ""))
    link = pf.absolute_url("href", _site_base(F.col("source"), F.col("url")))
    for src, param in CANONICAL_PARAM.items():
        link = F.when(F.col("source") == src, pf.canonical_by_param(link, SITE_BASE_URLS[src], param)).otherwise(link)
    return hrefs.select("source", link.alias("link")).where(F.col("link").isNotNull()).distinct()
