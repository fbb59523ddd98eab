"""Extraction rules per source, as data.

Each entry is ``(input, kind, selector, params)``. Entries with the same
input name are fallbacks tried in order; an empty result falls through to
the next one (Python ``a or b``). Kinds are implemented in
``postlake.operators.extract``; the native assembly that turns inputs into
the 15 posting fields is in ``postlake.plans.postings``.
"""

from __future__ import annotations

# --- fixed values: selectors per source, in priority order ---
EXTRACTION_RULES: dict[str, list[tuple[str, str, str, dict]]] = {
    "getonboard": [
        ("title", "text", "h1.gb-landing-cover__title", {}),
        ("title", "text", "h1", {}),
        ("company", "text", "a.tooltipster", {}),
        ("location", "text", "span[itemprop='jobLocation'] a", {"exists_wins": True}),
        ("location", "text", "a[href*='/empleos/ciudad/']", {}),
        ("description", "texts", "div.gb-rich-txt", {"keep_blank": True}),
        ("tags", "texts", "a.gb-tags__item", {"keep_blank": True}),
        ("skills_a", "texts", "span.tag.bg_brand_light", {"keep_blank": True}),
        ("skills_b", "texts", "ul.disc.mbB li", {"keep_blank": True}),
        ("posted_date", "attr", "time[itemprop='datePosted']", {"attr": "datetime"}),
        ("posted_date", "text", "div.color-hierarchy2 time", {}),
        ("salary_min", "attr", "span[itemprop='minValue']", {"attr": "content"}),
        ("salary_max", "attr", "span[itemprop='maxValue']", {"attr": "content"}),
        ("salary_currency", "attr", "span[itemprop='currency']", {"attr": "content"}),
        ("salary_unit", "attr", "span[itemprop='unitText']", {"attr": "content"}),
        ("applicants_text", "text", "div.size0.mt1", {}),
        ("experience", "text", "span[itemprop='qualifications']", {}),
        ("job_type_strings", "strings", "h2.size1", {}),
        ("modality_text", "text", "span[itemprop='jobLocation']", {}),
    ],
    "zonajobs": [
        ("title", "text", "h1", {"mode": "raw"}),
        ("company", "first_string", "a[href*='/perfiles/'], span[data-url*='/perfiles/']", {}),
        ("tags", "following", "i[name*='location']", {"target": "h2", "n": 1}),
        ("posted_date", "following", "i[name*='location']", {"target": "h2", "n": 2}),
        ("location", "following", "i[name*='location']", {"target": "h2", "n": 3}),
        ("modality_text", "following", "i[name*='office']", {"target": "p", "each": 1, "n": 2}),
        ("description", "text", "#ficha-detalle > div:nth-of-type(2) > div > div", {"mode": "raw"}),
        ("job_type", "following", "i[name*='clock']", {"target": "p", "each": 1, "n": 1}),
        ("experience", "following", "i[name*='award']", {"target": "p", "each": 1, "n": 1}),
        ("skills", "text", "#ficha-detalle > div:nth-of-type(2) > div > div > p > ul:nth-of-type(4)", {"mode": "raw"}),
        ("skills", "text", "#ficha-detalle > div:nth-of-type(2) > div > div > p > p:nth-of-type(5)", {"mode": "raw"}),
    ],
    "indeed": [
        ("jsonld", "script", "script[type='application/ld+json']", {}),
        ("title", "text", "h1[data-testid='jobsearch-JobInfoHeader-title']", {}),
        ("company", "text", "a[data-testid='company-name']", {}),
        ("location", "text", "div[data-testid='jobsearch-JobInfoHeader-location']", {}),
        ("description", "text", "#jobDescriptionText", {"mode": "newline"}),
        ("has_description", "exists", "#jobDescriptionText", {}),
    ],
    "computrabajo": [
        ("title", "text", "h1.fwB.fs24.mb5.box_detail.w100_m", {"mode": "raw", "exists_wins": True}),
        ("title", "text", "h1", {"mode": "raw"}),
        ("company_line", "text", "p.fs16", {"mode": "all", "scope": "div.container", "scope_nth": 1}),
        ("location_fallback", "text", "p.fs16", {"mode": "raw", "has_text": "Capital Federal"}),
        ("description_parts", "texts", "div[div-link='oferta'] p", {"mode": "raw", "keep_blank": True}),
        ("description_fallback", "text", "div.mb40.pb40.bb1[div-link='oferta']", {"mode": "raw"}),
        ("tags", "texts", "span.tag.base.mb10", {"mode": "raw"}),
        ("skills_a", "texts", "span.tag.bg_brand_light.fc_base", {"mode": "raw"}),
        ("skills_b", "texts", "ul.disc.mbB li", {"mode": "raw"}),
        ("posted_date", "text", "p.fc_aux.fs13", {"mode": "raw", "has_text": "días", "exists_wins": True}),
        ("posted_date", "text", "p.fc_aux", {"mode": "raw", "has_text": "Hace"}),
        ("salary", "text", "span.tag.base.mb10", {"mode": "raw", "has_text": "convenir"}),
    ],
    "portal_empleo": [
        ("title", "text", "h3.text-capitalize.text-turqueza", {}),
        ("title", "text", "h3", {}),
        ("company", "text", "div > svg ~ text", {}),
        ("company", "text", "strong", {}),
        ("location", "text", "div.col-md-12 p span", {}),
        ("location", "text", "svg.fa-map-marker-alt ~ span", {}),
        ("location", "text", "svg.fa-map-marker-alt ~ text", {}),
        ("availability", "label_next", "label.fw-600", {"contains": "Disponibilidad", "target": "p"}),
        ("experience", "label_next", "label.fw-600", {"contains": "Experiencia Requerida", "target": "p"}),
        ("skills", "section_values", ".row", {
            "heading": "h2", "contains": "Requisitos", "labels": "label.fw-600",
            "exclude": "Experiencia Requerida", "target": "p", "drop": ["no", ""],
        }),
        ("description", "section_text", "h2", {
            "keywords": ["resumen", "tareas", "principales tareas"], "stop": ["h2", "label"],
            "collect": "p", "fallback": "p",
        }),
        ("posted_date", "text", ".float-right.mt-2", {}),
        ("tags", "texts", "label.fw-600", {"keep_blank": True}),
        ("page_text", "page_text", "", {}),
    ],
}

# Generic rules for article-shaped pages (no site-specific markup).
ARTICLE_RULES: list[tuple[str, str, str, dict]] = [
    ("title", "text", "article h1", {}),
    ("title", "text", "h1", {}),
    ("description_parts", "texts", "article > p", {}),
    ("tags", "texts", "nav li", {}),
    ("skills", "texts", "nav a", {}),
    ("location", "text", "div.ad", {}),
    ("page_text", "page_text", "", {}),
]
EXTRACTION_RULES["article"] = ARTICLE_RULES

# Sources whose pages were read through a repairing parser (lxml, a browser
# DOM): their trees get the HTML standard's implicit end tags.
REPAIR_SOURCES: frozenset[str] = frozenset({"zonajobs", "computrabajo"})

# --- fixed values: detail-page host → source (site base URLs) ---
SOURCE_HOSTS: dict[str, str] = {
    "www.computrabajo.com.ar": "computrabajo",
    "ar.indeed.com": "indeed",
    "portalempleo.gob.ar": "portal_empleo",
    "www.zonajobs.com.ar": "zonajobs",
    "www.getonbrd.com": "getonboard",
}

# --- fixed values: detail-link selectors on listing pages ---
LISTING_RULES: dict[str, list[tuple[str, str, str, dict]]] = {
    "getonboard": [("links", "attrs", "div.gb-results-list a", {"attr": "href"})],
    "zonajobs": [("links", "attrs", "main#listado-avisos a[href*='/empleos/']", {"attr": "href"})],
    "portal_empleo": [("links", "attrs", "a.btn.btn-success.comp-button-ciudadanos", {"attr": "href"})],
    "computrabajo": [("links", "attrs", "a.js-o-link.fc_base", {"attr": "href"})],
    "indeed": [("links", "attrs", "a[href*='/rc/clk?jk='], a[href*='/viewjob?jk=']", {"attr": "href"})],
    "article": [("links", "attrs", "nav a", {"attr": "href"})],
}
# Sources whose detail URLs are canonicalised by one query parameter.
CANONICAL_PARAM: dict[str, str] = {"indeed": "jk"}
