"""DuckDB oracle SQL for the driver queries (same column names as Spark)."""

from __future__ import annotations

from postlake.plans import driver as d
from postlake.plans import oracle as o
from postlake.plans import site_pages
from postlake.rules.sites import (
    DEFAULT_MAX_PAGES,
    SITE_MAX_PAGES,
)
from postlake.rules.stopwords import STOPWORDS_ES


def _in_list(words) -> str:
    return "(" + ", ".join(o.q(w) for w in words) + ")"


def _region_case(e: str, rules, remote_words) -> str:
    cleaned = o.noise(f"lower({e})")
    parts = [f"WHEN {e} IS NULL THEN NULL"]
    if remote_words:
        parts.append(f"WHEN {o.any_contains(cleaned, remote_words)} THEN 'remote'")
    for label, words in rules:
        parts.append(f"WHEN {o.any_contains(cleaned, words)} THEN {o.q(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {cleaned} END"


def _classify(e: str, rules, default: str) -> str:
    low = f"lower({e})"
    parts = [f"WHEN {e} IS NULL THEN {o.q(default)}"]
    for label, words in rules:
        parts.append(f"WHEN {o.any_contains(low, words)} THEN {o.q(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {o.q(default)} END"


def _first_matching(lst: str, words) -> str:
    cond = " OR ".join(f"contains(lower(x), {o.q(w.lower())})" for w in words)
    return f"(list_filter({lst}, lambda x: {cond}))[1]"


def _any_match(lst: str, words) -> str:
    cond = " OR ".join(f"contains(lower(x), {o.q(w.lower())})" for w in words)
    return f"(len(list_filter({lst}, lambda x: {cond})) > 0)"


def _clean_list(lst: str, drops) -> str:
    stripped = f"list_transform({lst}, lambda x: {o.strip('x')})"
    dl = _in_list([w.lower() for w in drops])
    return f"list_filter({stripped}, lambda x: x IS NOT NULL AND x <> '' AND lower(x) NOT IN {dl})"


def _event_html() -> str:
    js = (
        "'{\"@type\": \"JobPosting\", \"title\": \"' || event_type || ' #' || CAST(event_id AS VARCHAR) || "
        "'\", \"hiringOrganization\": {\"name\": \"user ' || CAST(user_id AS VARCHAR) || "
        "'\"}, \"jobLocation\": {\"address\": {\"addressLocality\": \"' || upper(event_type) || "
        "'\"}}, \"datePosted\": \"' || strftime(ts, '%Y-%m-%d') || '\", \"props\": ' || props || "
        "CASE WHEN event_type = 'error' THEN '' ELSE '}' END"
    )
    html = (
        "'<html><head><script type=\"application/ld+json\">' || (" + js + ") || '</script></head><body><h1>' || "
        "event_type || ' page ' || CAST(event_id AS VARCHAR) || '</h1></body></html>'"
    )
    return js, html


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    k = d.TOP_K

    sql["top_tokens"] = f"""
WITH t AS (SELECT unnest({o.tokens(o.punct('lower(text)'))}) AS token FROM documents)
SELECT token, count(*) AS freq FROM t
WHERE token NOT IN {_in_list(STOPWORDS_ES)}
GROUP BY token ORDER BY freq DESC, token ASC LIMIT {k}"""

    sql["title_prefix_topk_share"] = f"""
WITH p AS (SELECT {o.first_words('text', d.PREFIX_WORDS)} AS prefix FROM documents),
f AS (SELECT prefix, count(*) AS freq FROM p WHERE prefix IS NOT NULL
      GROUP BY prefix ORDER BY freq DESC, prefix ASC LIMIT {k})
SELECT prefix, freq, CAST(sum(freq) OVER () AS BIGINT) AS top_total,
       round(freq / sum(freq) OVER (), 6) AS share FROM f"""

    sql["lineitem_top_parts"] = f"""
WITH f AS (SELECT l_partkey, count(*) AS freq FROM lineitem WHERE l_partkey IS NOT NULL
           GROUP BY l_partkey ORDER BY freq DESC, l_partkey ASC LIMIT {k})
SELECT l_partkey, freq, CAST(sum(freq) OVER () AS BIGINT) AS top_total,
       round(freq / sum(freq) OVER (), 6) AS share FROM f"""

    coords = ", ".join(f"({o.q(c)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for c, lat, lon in d.PART_CATEGORY_COORDS)
    sql["category_counts_coords"] = f"""
WITH c AS (SELECT {_region_case('p_name', d.PART_CATEGORY_RULES, d.PART_REMOTE_WORDS)} AS category FROM part),
g AS (SELECT category, count(*) AS freq FROM c WHERE category <> 'remote' AND category IS NOT NULL GROUP BY category)
SELECT g.category, g.freq, k.lat, k.lon, g.freq AS size
FROM g LEFT JOIN (VALUES {coords}) AS k(category, lat, lon) ON g.category = k.category"""

    rule_case = "CASE " + " ".join(
        f"WHEN {o.any_contains('p_name', words)} THEN {o.q(label)}" for label, words in d.PART_CATEGORY_RULES
    ) + " END"
    sql["category_rules_table"] = f"""
WITH c AS (SELECT {rule_case} AS category FROM part WHERE p_name IS NOT NULL)
SELECT category, count(*) AS freq FROM c WHERE category IS NOT NULL GROUP BY category"""

    sql["category_rules_indexed"] = r"""
WITH r AS (SELECT doc_id AS priority, source AS category, regexp_extract(text, '^[^ \n]+ ([^ \n]+)', 1) AS keyword FROM documents),
     h AS (SELECT page_id, min_by(category, priority) AS category
           FROM pages JOIN r ON keyword <> '' AND contains(url, keyword) GROUP BY page_id)
SELECT page_id, h.category FROM pages LEFT JOIN h USING (page_id)"""

    sql["normalize_text"] = f"""
SELECT doc_id, {o.noise(o.strip('lower(text)'))} AS norm_text FROM documents"""

    sql["title_case"] = f"""
WITH b AS (SELECT 'part' AS src, p_partkey AS id, p_name AS raw FROM part
           UNION ALL SELECT 'documents', doc_id, text FROM documents),
t AS (SELECT src, id, CASE WHEN raw IS NULL THEN NULL ELSE {o.title_case(o.strip('raw'))} END AS title FROM b)
SELECT src, id, title, lower(title) AS title_lower FROM t"""

    sql["job_key"] = f"""
WITH t AS (SELECT page_id, url, {o.first_tag_text('html')} AS title, {o.host('url')} AS company FROM pages)
SELECT page_id, title, company,
       left(sha256(coalesce(url, '') || coalesce(title, '') || coalesce(company, '')), 20) AS job_key FROM t"""

    sql["dedup_by_key"] = """
SELECT doc_id, sha256(text) AS dedup_key, lang FROM documents
QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1"""

    sql["dedup_links"] = f"""
WITH h AS (SELECT {o.origin('url')} AS base, unnest({o.hrefs('html')}) AS href FROM pages),
l AS (SELECT {o.absolute_url('href', 'base')} AS link FROM h)
SELECT DISTINCT link FROM l WHERE link IS NOT NULL AND link <> ''"""

    sql["page_titles"] = f"SELECT page_id, {o.first_tag_text('html')} AS title FROM pages"

    phrases = " OR ".join(f"contains(lower(html), {o.q(p.lower())})" for p in d.TEST_BLOCK_PHRASES)
    sql["blocked_pages"] = f"""
WITH f AS (SELECT regexp_extract(url, '://[^/]+/([a-z]{{2}})/', 1) AS section,
                  coalesce(html = '' OR {phrases}, true) AS blocked,
                  ({o.first_tag_text('html')} IS NOT NULL) AS has_title FROM pages)
SELECT section, count(*) AS links, count(*) AS processed,
       count(*) FILTER (WHERE blocked) AS blocked,
       count(*) FILTER (WHERE NOT blocked AND has_title) AS parsed
FROM f GROUP BY section"""

    js, html = _event_html()
    sql["jsonld_fields"] = f"""
WITH p AS (SELECT event_id, {html} AS html FROM events),
j AS (SELECT event_id, html, nullif(regexp_extract(html, {o.q(r'(?is)<script\b[^>]*\btype\s*=\s*["' + "'" + r']application/ld\+json["' + "'" + r'][^>]*>(.*?)</script\s*>')}, 1), '') AS js FROM p),
v AS (SELECT event_id, html, js, coalesce(json_valid(js), false) AS ok FROM j)
SELECT event_id,
       coalesce(nullif(CASE WHEN ok THEN json_extract_string(js, '$.title') END, ''), {o.first_tag_text('html')}) AS title,
       CASE WHEN ok THEN json_extract_string(js, '$.hiringOrganization.name') END AS company,
       CASE WHEN ok THEN json_extract_string(js, '$.jobLocation.address.addressLocality') END AS location,
       CASE WHEN ok THEN json_extract_string(js, '$.datePosted') END AS posted_date,
       ok AS jsonld_ok
FROM v"""

    sql["modality_class"] = f"""
SELECT p_partkey,
       {_classify("concat_ws(' ', p_type, p_name)", d.PART_MODALITY_RULES, 'Otros')} AS modality,
       {_any_match("string_split(p_name, ' ')", d.PART_TAG_WORDS)} AS has_tag_word,
       {_first_matching("string_split(p_name, ' ')", d.PART_TAG_WORDS)} AS first_tag
FROM part"""

    sql["split_company_location"] = f"""
WITH s AS (SELECT o_orderkey, o_orderpriority AS c, string_split(o_orderpriority, '-') AS p FROM orders)
SELECT o_orderkey,
       CASE WHEN len(p) > 1 THEN {o.strip("array_to_string(p[1:len(p) - 1], '-')")} ELSE {o.strip('c')} END AS company,
       CASE WHEN len(p) > 1 THEN {o.strip('p[-1]')} END AS location
FROM s"""

    sql["first_int"] = """
SELECT c_custkey, TRY_CAST(nullif(regexp_extract(c_name, '([0-9]+)', 1), '') AS INTEGER) AS first_int FROM customer"""

    sql["first_date"] = r"""
WITH t AS (SELECT o_orderkey, o_orderdate,
                  'Pedido ' || CAST(o_orderkey AS VARCHAR) || ' publicado el ' || strftime(o_orderdate, '%d/%m/%Y') || ' (ref 12/345)' AS text
           FROM orders)
SELECT o_orderkey, nullif(regexp_extract(text, '\b([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})\b', 1), '') AS posted_date,
       strftime(o_orderdate, '%Y-%m-%d') AS ds, strftime(now() AT TIME ZONE 'UTC', '%Y-%m-%d') AS run_ds FROM t"""

    sql["salary_string"] = """
WITH t AS (SELECT p_partkey, p_name, p_brand,
                  CASE WHEN p_type <> 'ECONOMY' THEN p_size END AS lo,
                  CAST(p_retailprice AS DECIMAL(12,2)) AS hi,
                  CASE WHEN p_size <= 25 THEN 'month' END AS unit FROM part)
SELECT p_partkey,
       CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN CAST(lo AS VARCHAR) || ' - ' || CAST(hi AS VARCHAR) END AS salary,
       CASE WHEN p_brand IS NOT NULL AND unit IS NOT NULL THEN p_brand || '/' || unit END AS salary_currency,
       CASE WHEN contains(lower(p_name), 'ring') THEN 'A Convenir' END AS negotiable
FROM t"""

    sites = ", ".join(f"({o.q(s)}, {n})" for s, n in SITE_MAX_PAGES.items())
    sql["canonical_url"] = f"""
WITH t AS (SELECT page_id, url, {o.origin('url')} AS base, {o.host('url')} AS host,
                  {o.first_tag_text('html')} AS title FROM pages),
k AS (SELECT page_id,
             CASE WHEN regexp_extract(url, 'page=([a-zA-Z0-9]+)', 1) <> ''
                  THEN base || '/viewjob?page=' || regexp_extract(url, 'page=([a-zA-Z0-9]+)', 1) ELSE url END AS canonical,
             replace(lower(title), ' ', '-') AS slug,
             left(regexp_replace(title, '[^a-zA-Z0-9_\\-]', '_', 'g'), 200) AS safe_name,
             replace(lower(host), ' ', '_') AS site_key FROM t)
SELECT k.page_id, k.canonical, k.slug, k.safe_name, k.site_key, coalesce(s.site_max_pages, {DEFAULT_MAX_PAGES}) AS max_pages
FROM k LEFT JOIN (VALUES {sites}) AS s(site_key, site_max_pages) ON k.site_key = s.site_key"""

    cols = [("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
            ("quality", "int"), ("toxic", "int")]
    rows = " UNION ALL ".join(
        f"SELECT {o.q(c)} AS column_name, {i + 1} AS position, {o.q(t)} AS data_type, "
        f"n - count({c}) AS null_count, count({c}) AS non_null_count, "
        f"n AS total_rows, {len(cols)} AS total_columns FROM j, (SELECT count(*) AS n FROM j) GROUP BY n"
        for i, (c, t) in enumerate(cols)
    )
    sql["null_profile"] = f"""
WITH j AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
{rows}"""

    sql["contains_filters"] = r"""
SELECT doc_id, lang, 'word' AS hit FROM documents WHERE lang = 'es' AND contains(lower(text), 'dos')
UNION ALL SELECT doc_id, lang, 'regex' FROM documents WHERE regexp_matches(lower(text), '\b[a-z]+@[a-z]+\.|[0-9]{2,}\.[0-9]+')"""

    a = _clean_list("string_split(p_name, ' ')", ["no"])
    b = _clean_list("[p_brand, p_type, ' ', 'No']", ["no"])
    sql["list_ops"] = f"""
WITH s AS (SELECT p_partkey, list_sort(list_distinct(list_concat({a}, {b}))) AS s FROM part)
SELECT p_partkey, CASE WHEN len(s) > 0 THEN array_to_string(s, chr(10)) END AS skills,
       CAST(len(s) AS INTEGER) AS n_skills, {_first_matching('s', ['ring', 'bolt'])} AS first_hit FROM s"""

    sql["union_by_name"] = """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier"""

    sql["head_preview"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5"""

    sql["links_join_pages"] = f"""
WITH f AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS link, {o.first_tag_text('html')} AS title,
                  CAST(length(html) AS INTEGER) AS html_chars FROM pages),
l AS (SELECT DISTINCT link FROM f WHERE link IS NOT NULL AND link <> '')
SELECT l.link, f.page_id, f.title, f.html_chars FROM l JOIN f ON l.link = f.link"""

    sql["link_outcomes"] = f"""
WITH a AS (SELECT {o.origin('url')} AS base, unnest({o.hrefs('html')}) AS href FROM pages),
l AS (SELECT regexp_replace({o.absolute_url('href', 'base')}, '#.*$', '') AS link, 1 AS n, 0 AS p, NULL AS page_id FROM a
      UNION ALL SELECT 'https://ar.indeed.com/viewjob?jk=' || user_id, 1, 0, NULL FROM events
      UNION ALL SELECT regexp_replace(url, '#.*$', ''), 0, 1, page_id FROM pages
      UNION ALL SELECT 'https://ar.indeed.com/viewjob?jk=' || c_custkey, 0, 1, c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
t AS (SELECT link, CAST(sum(n) AS BIGINT) AS n_links, CAST(sum(p) AS BIGINT) AS n_pages, CAST(min(page_id) AS BIGINT) AS page_id
      FROM l WHERE link IS NOT NULL AND link <> '' GROUP BY link)
SELECT link, CASE WHEN n_pages = 0 THEN 'missing' WHEN n_links = 0 THEN 'unlinked' ELSE 'fetched' END AS outcome, n_links, n_pages, page_id FROM t"""

    domain = f"string_split({o.host('url')}, '.')[-1]"
    kept = "html IS NOT NULL AND html <> ''"
    sql["crawl_counters"] = f"""
WITH p AS (SELECT {domain} AS source, url, html, {o.first_tag_text('html')} AS h1 FROM pages),
c AS (SELECT source, count(*) AS links, count(*) FILTER (WHERE NOT ({kept})) AS blocked,
             count(DISTINCT coalesce(url, '') || coalesce(h1, '')) FILTER (WHERE {kept}) AS processed_rows
      FROM p WHERE source IN ('com', 'org') GROUP BY source)
SELECT links, links AS processed, blocked, links - blocked AS parsed, CAST(0 AS BIGINT) AS errors, processed_rows, '2024-01-01' AS ds, source FROM c"""

    def titles(ds: str, which: str) -> str:
        return f"""
SELECT ds, source, page_id, url, {o.title_case(o.strip('h1'))} AS title FROM (
  SELECT '{ds}' AS ds, {domain} AS source, page_id, url, {o.first_tag_text('html')} AS h1 FROM pages WHERE {kept} AND ({which}))
QUALIFY row_number() OVER (PARTITION BY source, coalesce(url, '') || coalesce(h1, '') ORDER BY url, page_id) = 1"""

    # the rerun had pages of one source only: it replaces that one
    longer = f"{domain} = 'org' OR ({domain} = 'com' AND length(html) >= 2000)"
    sql["committed_run"] = f"SELECT * FROM ({titles('2024-01-01', longer)}) UNION ALL SELECT * FROM ({titles('2024-01-02', f"{domain} IN ('com', 'org')")})"

    # the five sites spelled out: list-everything where the site has it, 31 pages each
    sql["frontier"] = """
WITH p AS (SELECT r_regionkey, r_name AS q, CAST(unnest(generate_series(1, 31)) AS INTEGER) AS page FROM region)
SELECT r_regionkey, 'getonboard' AS source, 1 AS page, 'https://www.getonbrd.com/empleos/' AS url FROM region
UNION ALL SELECT r_regionkey, 'zonajobs', page, 'https://www.zonajobs.com.ar/empleos.html?page=' || page FROM p
UNION ALL SELECT r_regionkey, 'portal_empleo', page, 'https://portalempleo.gob.ar/OfertasLaborales?page-number=' || page FROM p
UNION ALL SELECT r_regionkey, 'computrabajo', page,
  'https://www.computrabajo.com.ar/trabajo-de-' || replace(q, ' ', '-') || '/?p=' || page || '&q=Argentina' FROM p
UNION ALL SELECT r_regionkey, 'indeed', page,
  'https://ar.indeed.com/jobs?q=' || replace(q, ' ', '+') || '&l=Argentina&start=' || ((page - 1) * 10) FROM p"""

    nav_frag = f"regexp_extract({o.content_only('html')}, '(?is)<nav\\b[^>]*>(.*?)</nav\\s*>', 1)"
    nav_hrefs = o.hrefs(nav_frag)
    sql["listing_links"] = f"""
WITH h AS (SELECT {o.origin('url')} AS base, unnest({nav_hrefs}) AS href FROM pages),
l AS (SELECT {o.absolute_url('href', 'base')} AS link FROM h WHERE href IS NOT NULL AND href <> '')
SELECT DISTINCT 'article' AS source, link FROM l WHERE link IS NOT NULL"""

    sql["frontier_from_titles"] = f"""
WITH q AS (SELECT DISTINCT q FROM (SELECT {o.first_words('text', d.PREFIX_WORDS)} AS q FROM documents UNION ALL SELECT p_name FROM part) WHERE q IS NOT NULL AND q <> ''),
p AS (SELECT q, CAST(unnest(generate_series(1, 31)) AS INTEGER) AS page FROM q)
SELECT DISTINCT 'getonboard' AS source, 1 AS page, 'https://www.getonbrd.com/empleos-' || replace(q, ' ', '-') AS url FROM q
UNION SELECT 'zonajobs', page, 'https://www.zonajobs.com.ar/empleos-busqueda-' || replace(lower(q), ' ', '-') || '.html?page=' || page FROM p
UNION SELECT 'portal_empleo', page, 'https://portalempleo.gob.ar/OfertasLaborales?Q=' || replace(q, ' ', '+') || '?page-number=' || page FROM p
UNION SELECT 'computrabajo', page,
  'https://www.computrabajo.com.ar/trabajo-de-' || replace(q, ' ', '-') || '/?p=' || page || '&q=Argentina' FROM p
UNION SELECT 'indeed', page,
  'https://ar.indeed.com/jobs?q=' || replace(q, ' ', '+') || '&l=Argentina&start=' || ((page - 1) * 10) FROM p"""

    sql["roundtrip_sinks"] = """
SELECT o_orderkey, o_custkey, o_totalprice, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS ds,
       o_orderstatus AS source FROM orders"""

    nav = f"regexp_extract({o.content_only('html')}, '(?is)<nav\\b[^>]*>(.*?)</nav\\s*>', 1)"
    li = f"list_transform(regexp_extract_all({nav}, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1), lambda x: {o.fragment_text('x')})"
    a = f"list_transform(regexp_extract_all({nav}, '(?is)<a\\b[^>]*>(.*?)</a\\s*>', 1), lambda x: {o.fragment_text('x')})"
    ad = f"regexp_extract({o.content_only('html')}, '(?is)<div\\b[^>]*class=\"ad\"[^>]*>(.*?)</div\\s*>', 1)"
    sql["extract_rules"] = f"""
SELECT page_id, {o.first_tag_text('html')} AS title, {o.host('url')} AS company,
       {o.fragment_text(ad)} AS location,
       array_to_string(list_filter({li}, lambda x: x <> ''), chr(10)) AS tags,
       array_to_string(list_sort(list_distinct(list_filter({a}, lambda x: x <> ''))), chr(10)) AS skills,
       true AS parse_ok
FROM pages"""

    article = f"regexp_extract({o.content_only('html')}, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)"
    own = "list_transform((string_split_regex(art, '(?i)<p(?:\\s[^>]*)?>'))[2:], lambda x: (string_split_regex(x, '(?i)</p\\s*>'))[1])"
    parts = f"list_filter(list_transform({own}, lambda x: {o.fragment_text('x')}), lambda x: x <> '')"
    date = r"\b([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})\b"
    text = f"replace({o.decode("regexp_replace(" + o.content_only('html') + ", '<[^>]*>', chr(1), 'g')")}, chr(1), '')"
    sql["postings_daily_run"] = f"""
WITH p AS (
  SELECT url, {article} AS art, {o.first_tag_text('html')} AS h1, {o.host('url')} AS company, {o.fragment_text(ad)} AS loc,
         nullif(regexp_extract({text}, '{date}', 1), '') AS posted_date,
         array_to_string(list_filter({li}, lambda x: x <> ''), chr(10)) AS tags,
         array_to_string(list_sort(list_distinct(list_filter({a}, lambda x: x <> ''))), chr(10)) AS skills, page_id
  FROM pages WHERE html IS NOT NULL AND html <> ''
), x AS (
  SELECT *, left(sha256(coalesce(url, '') || coalesce(h1, '') || coalesce(company, '')), 20) AS job_key, {parts} AS parts FROM p
), t AS (
  SELECT *, {o.title_case(o.strip('h1'))} AS title FROM x QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY url, page_id) = 1
)
SELECT job_key, title, lower(title) AS title_lower, {o.strip('company')} AS company, {o.strip('loc')} AS location, posted_date, url,
       CASE WHEN len(parts) > 0 THEN CAST(length(array_to_string(parts, chr(10))) AS INTEGER) END AS description_chars,
       tags, skills, 'article' AS source_site, 'article' AS source, '2024-01-01' AS ds
FROM t"""

    sql["recursive_scan"] = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
       o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders"""

    sql["dedup_across_runs"] = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus AS source, year(o_orderdate) AS y FROM orders),
     n AS (SELECT * FROM o WHERE y = 2001
           QUALIFY row_number() OVER (PARTITION BY source, o_custkey, o_orderpriority ORDER BY o_orderkey) = 1)
SELECT o_orderkey, o_custkey, o_orderpriority, source FROM n
WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.y BETWEEN 1999 AND 2000 AND o.source = n.source
                  AND o.o_custkey = n.o_custkey AND o.o_orderpriority = n.o_orderpriority)"""

    sql["drifting_scan"] = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE replace(o_orderpriority, '-', '|') END AS priority
FROM orders"""

    sql["observe_counts"] = """
SELECT 'scanned' AS stage, count(*) AS rows FROM part
UNION ALL SELECT 'kept', count(*) FROM part WHERE p_size > 10"""
    return {**sql, **site_pages.SQL}
