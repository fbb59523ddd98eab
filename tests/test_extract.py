"""Extraction job per source on invented fixtures (full, missing fields,
blocked, malformed); expected rows written by hand."""

import pytest

from postlake.operators.extract import extract_inputs
from postlake.plans import postings
from postlake.rules.extraction import EXTRACTION_RULES
from tests.fixtures import html_pages as H

PAGES = [
    (1, "getonboard", "https://www.getonbrd.com/empleos/data-engineer", H.GETONBOARD_FULL),
    (2, "getonboard", "https://www.getonbrd.com/empleos/analista", H.GETONBOARD_MISSING),
    (3, "zonajobs", "https://www.zonajobs.com.ar/empleos/1.html", H.ZONAJOBS_FULL),
    (4, "indeed", "https://ar.indeed.com/viewjob?jk=1", H.INDEED_JSONLD),
    (5, "indeed", "https://ar.indeed.com/viewjob?jk=2", H.INDEED_NO_JSONLD),
    (6, "indeed", "https://ar.indeed.com/viewjob?jk=3", H.INDEED_MALFORMED),
    (7, "indeed", "https://ar.indeed.com/viewjob?jk=4", H.INDEED_NOTHING),
    (8, "indeed", "https://ar.indeed.com/viewjob?jk=5", H.INDEED_BLOCKED),
    (9, "computrabajo", "https://www.computrabajo.com.ar/ofertas/1", H.COMPUTRABAJO_FULL),
    (10, "computrabajo", "https://www.computrabajo.com.ar/ofertas/2", H.COMPUTRABAJO_NO_SEP),
    (11, "portal_empleo", "https://portalempleo.gob.ar/Oferta/1", H.PORTAL_FULL),
    (12, "portal_empleo", "https://portalempleo.gob.ar/Oferta/2", H.MALFORMED),
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(PAGES, "page_id long, source string, url string, html string")
    out = postings.extract_postings(df).collect()
    return {r.page_id: r.asDict() for r in out}


def test_kept_and_dropped(rows):
    # 7: neither JSON-LD nor description (F3); 8: blocked (F2); 12: no HTML (F1)
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 9, 10, 11]


def test_getonboard(rows):
    r = rows[1]
    assert r["title"] == "DataEngineer"
    assert r["company"] == "ACME SA"
    assert r["location"] == "Córdoba"
    assert r["description_raw"] == "Build pipelines.\nUse Spark."
    assert r["tags"] == ["python", "spark"]
    assert r["skills"] == ["Airflow", "Python", "SQL"]
    assert r["posted_date"] == "2024-04-17"
    assert r["salary"] == "1000 - 2000" and r["salary_currency"] == "USD/MONTH"
    assert r["applicants"] == 12
    assert r["experience_level"] == "Semi Senior"
    assert r["job_type"] == "Full time"
    assert r["modality"] == "Remoto"
    assert r["source_site"] == "get_on_board"
    m = rows[2]
    assert m["title"] == "Analista" and m["posted_date"] == "hace 2 días"
    assert m["company"] is None and m["modality"] == "Otros" and m["salary"] is None and m["tags"] == []


def test_zonajobs(rows):
    r = rows[3]
    assert r["title"] == "Analista de Datos"
    assert r["company"] == "Empresa X"
    assert r["tags"] == ["Tecnología"]
    assert r["posted_date"] == "Publicado hace 3 días"
    assert r["location"] == "Palermo, Buenos Aires"
    assert r["modality"] == "Híbrido"
    assert r["job_type"] == "Full-time" and r["experience_level"] == "Senior"
    assert r["description_raw"] == "Descripción del puesto"
    assert r["salary_currency"] == "$ARS" and r["skills"] == []


def test_indeed(rows):
    r = rows[4]
    assert (r["title"], r["company"], r["location"]) == ("Data Analyst", "Globant", "Rosario")
    assert r["job_type"] == "FULL_TIME" and r["posted_date"] == "2024-04-10"
    assert r["description_raw"] == "Line one\nLine two"  # empty JSON-LD description falls through
    n = rows[5]
    assert (n["title"], n["company"], n["location"]) == ("BI Developer", "Mercado", "CABA")
    assert rows[6]["title"] == "Fallback Title" and rows[6]["description_raw"] == "Desc"


def test_computrabajo(rows):
    r = rows[9]
    assert r["title"] == "Analista BI"
    assert r["company"] == "Grupo Metropol - Sub" and r["location"] == "San Nicolás, Capital Federal"
    assert r["description_raw"] == "Tareas: reportes\nRequisitos: SQL"
    assert r["tags"] == ["Jornada completa", "Presencial y remoto", "Salario a convenir"]
    assert r["job_type"] == "Jornada completa" and r["modality"] == "Presencial y remoto"
    assert r["salary"] == "Salario a convenir" and r["posted_date"] == "Hace 3 días"
    assert r["skills"] == ["Power BI", "SQL"]
    s = rows[10]
    assert s["company"] == "Solo Empresa" and s["location"] == "Capital Federal" and s["title"] == "Cajero"


def test_portal_empleo(rows):
    r = rows[11]
    assert r["title"] == "operario de depósito"
    assert r["company"] == "MARIA ALICIA MARTINELLI"
    assert r["location"] == "Rosario, Santa Fe (presencial)"
    assert r["modality"] == "Presencial"
    assert r["job_type"] == "Tiempo completo"
    assert r["experience_level"] == "No"
    assert r["skills"] == ["Secundario completo"]
    assert r["description_raw"] == "Carga y descarga.\nControl de stock."
    assert r["salary"] == "A Convenir" and r["posted_date"] == "05/03/2024"
    assert r["tags"] == ["Disponibilidad horaria", "Experiencia Requerida", "Educación", "Idiomas"]


def test_error_rows_do_not_fail_the_job(spark):
    df = spark.createDataFrame([(1, "nosuchsource", "http://x", "<html></html>")], "page_id long, source string, url string, html string")
    out = postings.extract_postings(df, keep_errors=True).collect()
    assert len(out) == 1 and out[0].parse_ok is False and "nosuchsource" in out[0].parse_error
    r = out[0].asDict()
    assert r["url"] == "http://x" and r["source_site"] == "nosuchsource" and r["tags"] == [] and r["skills"] == []
    assert all(r[f] is None for f in ("title", "company", "location", "salary", "salary_currency", "modality", "applicants"))


def test_inputs_match_python_reading():
    got = extract_inputs(H.GETONBOARD_FULL, EXTRACTION_RULES["getonboard"])
    assert got["job_type_strings"] == ["Full time", "Remote"]
    assert got["title"] == ["DataEngineer"]


def test_fallback_edges(spark):
    pages = [
        (21, "portal_empleo", "https://portalempleo.gob.ar/Oferta/3", H.PORTAL_TWO_AVAILABILITY),
        (22, "getonboard", "https://www.getonbrd.com/empleos/3", H.GETONBOARD_EMPTY_LOCATION),
        (23, "computrabajo", "https://www.computrabajo.com.ar/ofertas/3", H.COMPUTRABAJO_BLANK_DESC),
    ]
    df = spark.createDataFrame(pages, "page_id long, source string, url string, html string")
    rows = {r.page_id: r for r in postings.extract_postings(df).collect()}
    assert rows[21].job_type == "Tiempo parcial"  # the first label's value names no schedule
    assert rows[22].location == ""  # the element exists: no fallback to the city link
    assert rows[23].title == ""  # the specific <h1> exists (empty): no fallback
    assert rows[23].company == "" and rows[23].location is None  # whitespace-only line: stripped, no " - "
    assert rows[23].description_raw == ""  # blank paragraphs exist: no fallback to the block


def test_new_source_from_rules_alone(spark):
    rules = dict(EXTRACTION_RULES)
    rules["mysite"] = [
        ("title", "text", "h1.job", {}),
        ("company", "text", ".org", {}),
        ("skills", "texts", "ul.req li", {}),
        ("applicants", "text", "span.n", {}),
    ]
    html = '<h1 class="job"> QA </h1><p class="org">Co</p><ul class="req"><li>Java</li><li>SQL</li></ul><span class="n">7</span>'
    df = spark.createDataFrame([(1, "mysite", "https://my.site/j/1", html)], "page_id long, source string, url string, html string")
    r = postings.extract_postings(df, rules).collect()[0]
    assert (r.title, r.company, r.skills, r.applicants, r.source_site) == ("QA", "Co", ["Java", "SQL"], 7, "mysite")
    assert r.tags is None and r.salary is None


def test_missing_and_malformed_pages(spark):
    pages = [
        (31, "zonajobs", "https://www.zonajobs.com.ar/empleos/2.html", H.ZONAJOBS_MISSING),
        (32, "zonajobs", "https://www.zonajobs.com.ar/empleos/3.html", H.ZONAJOBS_MALFORMED),
        (33, "portal_empleo", "https://portalempleo.gob.ar/Oferta/4", H.PORTAL_MISSING),
        (34, "portal_empleo", "https://portalempleo.gob.ar/Oferta/5", H.PORTAL_MALFORMED),
    ]
    df = spark.createDataFrame(pages, "page_id long, source string, url string, html string")
    rows = {r.page_id: r for r in postings.extract_postings(df, keep_errors=True).collect()}
    assert all(r.parse_ok for r in rows.values())
    z = rows[31]
    assert (z.title, z.tags, z.location, z.posted_date, z.company, z.modality) == ("Vendedor", ["Ventas"], None, None, None, "Otros")
    m = rows[32]
    # zonajobs pages are parsed with implicit end tags (as lxml did): the
    # unclosed second <h2> ends where the third one starts
    assert m.title == "Cadete urgente" and m.tags == ["Log"] and m.location == "Rosario"
    assert m.posted_date == "Ayer"
    p = rows[33]
    assert (p.title, p.company, p.location, p.skills, p.description_raw, p.salary) == ("Ayudante", None, None, [], "Sin más datos", None)
    assert p.modality == "Otros" and p.salary_currency == "$ARS"
    q = rows[34]
    # the unclosed <h3> holds the rest of the page (no implicit closing)
    assert q.title == "MozoBar SurSalta (presencial)Experiencia RequeridaSí"
    assert q.company == "Bar Sur" and q.location == "Salta (presencial)"
    assert q.modality == "Presencial" and q.experience_level == "Sí"
