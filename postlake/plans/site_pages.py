"""Pages with the markup of three sites, landed from rows of the test tables, and what must be read from them.

The test tables hold no job markup, so each row of ``part``, ``orders`` and
``customer`` becomes one detail page. The pages are written to the shared
folder and read back before the extraction sees them; the SQL states the
expected fields from the columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.events import extract_events, split_rules
from postlake.plans import postings
from postlake.rules.extraction import EXTRACTION_RULES
from postlake.session import shared_dir
from postlake.sources import sinks
from postlake.sources.tables import read_table as read
from postlake.sources.tables import spread


def _html(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def portal_html() -> Column:
    """Labels with values, a section of requirements (not for ECONOMY), a summary; PROMO pages end inside a tag."""
    c = F.col
    return _html(
        '<html><body><h3 class="text-capitalize text-turqueza"> ', c("p_name"), "</h3><div><strong>", c("p_brand"),
        '</strong></div><div class="col-md-12"><p><span>', c("p_type"), " (presencial)</span></p></div>",
        '<div class="row"><label class="fw-600">Disponibilidad horaria</label><p>', F.when(c("p_size") > 25, "Tiempo Completo").otherwise("Tiempo parcial"), "</p></div>",
        F.when(c("p_type") != "ECONOMY", '<div class="row"><h2>Requisitos</h2></div>').otherwise(""),
        '<div class="row"><label class="fw-600">Experiencia Requerida</label><p>', c("p_size"), ' años</p><label class="fw-600">Educación</label><p>', c("p_brand"),
        '</p><label class="fw-600">Idiomas</label><p>', F.when(c("p_size") <= 10, "no").otherwise(c("p_type")), "</p></div>",
        "<div><h2>Resumen del puesto</h2><p>", c("p_name"), ".</p><p>Peso &amp; talle ", c("p_size"), "</p><br><p> </p><h2>Otros</h2><p>x</p></div>",
        F.when(c("p_type") == "PROMO", '<a href="/x').otherwise("</body></html>"),
    )


def zonajobs_html() -> Column:
    """Anchors with the facts behind them, second heading and first paragraph unclosed; no award for status P."""
    c = F.col
    return _html(
        "<html><body><h1> Pedido ", c("o_orderkey"), ' </h1><a href="/perfiles/', c("o_custkey"), '">Empresa ', c("o_custkey"),
        '</a><i name="icon-location"></i><h2>', c("o_orderpriority"), "</h2><h2>Publicado ", F.date_format("o_orderdate", "yyyy-MM-dd"), "<h2>", c("o_orderstatus"),
        ', Buenos Aires</h2><i name="icon-office"></i><p>Modalidad<i name="icon-office"></i><p>', F.when(c("o_orderstatus") == "F", "Híbrido").otherwise("Remoto"),
        '</p><i name="icon-clock"></i><p>Full-time</p>', F.when(c("o_orderstatus") != "P", '<i name="icon-award"></i><p>Senior</p>').otherwise(""), "</body></html>",
    )


def getonboard_html() -> Column:
    """Attributes by itemprop, an enumerated heading, tag lists; no salary for nation 0, no heading that names a type for BUILDING."""
    c = F.col
    return _html(
        '<html><body><h1 class="gb-landing-cover__title">', c("c_name"), "</h1><a class='x tooltipster'>", c("c_mktsegment"),
        '</a><span itemprop="jobLocation"><a href="/empleos/ciudad/x">Ciudad ', c("c_nationkey"), "</a> (Remoto)</span>",
        '<a class="gb-tags__item">', c("c_mktsegment"), '</a><a class="gb-tags__item"> data </a><span class="tag bg_brand_light">SQL</span><ul class="disc mbB"><li>SQL</li><li>Go</li></ul>',
        '<time itemprop="datePosted" datetime="2024-01-0', F.col("c_nationkey") % 9 + 1, '">hoy</time>',
        F.when(c("c_nationkey") > 0, _html('<span itemprop="minValue" content="', c("c_custkey"), "\"></span><span itemprop='maxValue' content='", c("c_custkey") + 5, "'></span>")).otherwise(""),
        '<span itemprop="currency" content="U&#83;D"></span><span itemprop=unitText content=MONTH></span><div class="size0 mt1"> ', c("c_custkey"),
        ' postulantes</div><h2 class="size1"><span>', F.when(c("c_mktsegment") == "BUILDING", "Otra").otherwise("Part time"), "</span> <span>Remote</span></h2></body></html>",
    )


def land(spark: SparkSession, sf_dir: str, table: str, key: str, source: str, url: str, html: Column) -> DataFrame:
    """Pages (page_id, source, url, html) of a table's rows, written and read back."""
    rows = spread(read(spark, sf_dir, table), always=True)  # rows are short, pages are not: deal out the rows
    pages = rows.select(F.col(key).alias("page_id"), F.lit(source).alias("source"), F.concat(F.lit(url), F.col(key).cast("string")).alias("url"), html.alias("html"))
    path = shared_dir(spark, f"landing-{source}")
    pages.write.parquet(path)
    return spark.read.schema(pages.schema).parquet(path)


def _postings(pages: DataFrame, source: str) -> DataFrame:
    native, _ = split_rules(EXTRACTION_RULES[source])
    return postings.extract_postings(pages, {source: native}, keep_errors=True, extractor=extract_events)


def _lines(name: str) -> Column:
    return F.array_join(name, "\n").alias(name)


def portal_fields(spark, sf_dir):
    """Label values, sections and their text; pages that fail go to a quarantine partition of the same write."""
    pages = land(spark, sf_dir, "part", "p_partkey", "portal_empleo", "https://portalempleo.gob.ar/Oferta/", portal_html())
    out = _postings(pages, "portal_empleo").select(
        "page_id", "title", "company", "location", "modality", "job_type", "experience_level", _lines("skills"), _lines("tags"),
        F.col("description_raw").alias("description"), F.col("parse_error").alias("reason"), "source", F.when(F.col("parse_ok"), "ok").otherwise("quarantine").alias("outcome"))
    base = shared_dir(spark, "portal-fields")
    sinks.write_layer(out, base, ("source", "outcome"))
    return sinks.read_layer(spark, base, out.schema)


def zonajobs_fields(spark, sf_dir):
    """H7: the nth heading and paragraph behind an anchor, in pages with unclosed elements."""
    pages = land(spark, sf_dir, "orders", "o_orderkey", "zonajobs", "https://www.zonajobs.com.ar/empleos/", zonajobs_html())
    return _postings(pages, "zonajobs").select("page_id", "title", "company", "location", "modality", "job_type", "experience_level", "posted_date", _lines("tags"))


def getonboard_fields(spark, sf_dir):
    """Values of attributes, lists and enumerated headings by selector data."""
    pages = land(spark, sf_dir, "customer", "c_custkey", "getonboard", "https://www.getonbrd.com/empleos/", getonboard_html())
    return _postings(pages, "getonboard").select("page_id", "title", "company", "location", "modality", "job_type", "salary", "salary_currency", "posted_date", "applicants", _lines("tags"), _lines("skills"), "url")


QUERIES = {"portal_fields": portal_fields, "zonajobs_fields": zonajobs_fields, "getonboard_fields": getonboard_fields}

SQL = {
    "portal_fields": """
WITH p AS (SELECT *, p_type <> 'PROMO' AS ok, CASE WHEN p_size <= 10 THEN [p_brand] ELSE list_sort([p_brand, p_type]) END AS req FROM part)
SELECT p_partkey AS page_id, CASE WHEN ok THEN p_name END AS title, CASE WHEN ok THEN p_brand END AS company,
       CASE WHEN ok THEN p_type || ' (presencial)' END AS location, CASE WHEN ok THEN 'Presencial' END AS modality,
       CASE WHEN ok THEN CASE WHEN p_size > 25 THEN 'Tiempo completo' ELSE 'Tiempo parcial' END END AS job_type,
       CASE WHEN ok THEN p_size || ' años' END AS experience_level,
       CASE WHEN ok AND p_type <> 'ECONOMY' THEN array_to_string(req, chr(10)) ELSE '' END AS skills,
       CASE WHEN ok THEN 'Disponibilidad horaria' || chr(10) || 'Experiencia Requerida' || chr(10) || 'Educación' || chr(10) || 'Idiomas' ELSE '' END AS tags,
       CASE WHEN ok THEN p_name || '.' || chr(10) || 'Peso & talle ' || p_size END AS description,
       CASE WHEN NOT ok THEN 'ends inside a tag' END AS reason, 'portal_empleo' AS source, CASE WHEN ok THEN 'ok' ELSE 'quarantine' END AS outcome
FROM p""",
    "zonajobs_fields": """
SELECT o_orderkey AS page_id, 'Pedido ' || o_orderkey AS title, 'Empresa ' || o_custkey AS company, o_orderstatus || ', Buenos Aires' AS location,
       CASE WHEN o_orderstatus = 'F' THEN 'Híbrido' ELSE 'Remoto' END AS modality, 'Full-time' AS job_type,
       CASE WHEN o_orderstatus <> 'P' THEN 'Senior' END AS experience_level, 'Publicado ' || strftime(o_orderdate, '%Y-%m-%d') AS posted_date, o_orderpriority AS tags
FROM orders""",
    "getonboard_fields": """
SELECT c_custkey AS page_id, c_name AS title, c_mktsegment AS company, 'Ciudad ' || c_nationkey AS location, 'Remoto' AS modality,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Part time' END AS job_type,
       CASE WHEN c_nationkey > 0 THEN c_custkey || ' - ' || (c_custkey + 5) END AS salary, 'USD/MONTH' AS salary_currency,
       '2024-01-0' || (c_nationkey % 9 + 1) AS posted_date, CAST(c_custkey AS INTEGER) AS applicants,
       c_mktsegment || chr(10) || 'data' AS tags, 'Go' || chr(10) || 'SQL' AS skills, 'https://www.getonbrd.com/empleos/' || c_custkey AS url
FROM customer""",
}
