"""Native extraction of article pages (H1-H3, H8, H9): no Python worker.

Article-shaped pages are flat enough for expressions: a title, one article
with paragraphs, one navigation list and an ad block. A paragraph ends at its
end tag, at the next paragraph or at the end of the article, as in the HTML
standard. The output has the shape of the rule mapper's
(``operators.extract``), so everything behind it is shared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import html as ph


def first_inner(html, tag: str) -> Column:
    """Inner markup of the first ``<tag>`` element (empty when missing)."""
    return F.regexp_extract(html, f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>", 1)


def texts(html, tag: str) -> Column:
    """Stripped non-empty texts of the ``<tag>`` elements, in order."""
    inner = F.regexp_extract_all(html, F.lit(f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>"), 1)
    return F.filter(F.transform(inner, lambda x: ph.fragment_text(x)), lambda x: x != "")


def paragraphs(article) -> Column:
    """Stripped non-empty paragraph texts of an article's markup."""
    opened = F.split(article, r"(?i)<p(?:\s[^>]*)?>")
    own = F.transform(F.slice(opened, F.lit(2), F.size(opened)), lambda x: F.get(F.split(x, r"(?i)</p\s*>"), F.lit(0)))
    return F.filter(F.transform(own, lambda x: ph.fragment_text(x)), lambda x: x != "")


def _one(value: Column) -> Column:
    return F.filter(F.array(value), lambda v: v.isNotNull())  # the value is worked out once


def extract_flat(pages: DataFrame, rules_by_source: Mapping | None = None, passthrough: Sequence[str] = (), repair_sources: Sequence[str] = ()) -> DataFrame:
    """``operators.extract.extract_pages`` for article pages; the other arguments are not used."""
    clean = pages.select(F.col("page_id").cast("long"), "source", "url", "html", *passthrough).withColumn("__c", ph.content_only("html"))
    nav, article = first_inner(F.col("__c"), "nav"), first_inner(F.col("__c"), "article")
    ad = F.regexp_extract("__c", r'(?is)<div\b[^>]*class="ad"[^>]*>(.*?)</div\s*>', 1)
    title = F.coalesce(F.nullif(ph.fragment_text(first_inner(article, "h1")), F.lit("")), ph.first_tag_text("html", "h1"))
    inputs = F.create_map(
        F.lit("title"), _one(title),
        F.lit("description_parts"), paragraphs(article),
        F.lit("tags"), texts(nav, "li"),
        F.lit("skills"), texts(nav, "a"),
        F.lit("location"), _one(ph.fragment_text(ad)),
        F.lit("links"), ph.hrefs(nav),
    )
    return clean.select(
        "page_id", "source", "url", F.lit(True).alias("parse_ok"), F.lit(None).cast("string").alias("parse_error"),
        inputs.alias("inputs"), ph.page_text("html").alias("page_text"), *passthrough,
    )
