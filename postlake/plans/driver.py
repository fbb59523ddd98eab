"""Driver queries: one Spark builder and one DuckDB oracle per name.

Every builder takes ``(spark, sf_dir)``, reads whole tables from
``{sf_dir}/<table>.parquet`` and returns a lazy DataFrame. Eight builders run
an action first because it is the operator under test: ``roundtrip_sinks``,
``recursive_scan``, ``drifting_scan``, ``dedup_across_runs``, ``postings_daily_run``,
``committed_run`` and ``crawl_counters`` write to a fresh folder under
the session's checkpoint dir and return the read-back rows;
``observe_counts`` runs one no-op write and returns its observed counts.
Column names match the oracle exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake import functions as pf
from postlake.functions import html as ph
from postlake.operators import dedup, frequency, lookup, profile
from postlake.operators.flat import extract_flat
from postlake.operators.observe import count_stages
from postlake.plans import analysis, postings, site_pages
from postlake.rules.extraction import EXTRACTION_RULES
from postlake.rules.sites import ALL_LISTING_TEMPLATES, BLOCK_PHRASES, DEFAULT_MAX_PAGES, SITE_BASE_URLS, SITE_MAX_PAGES
from postlake.session import shared_dir
from postlake.sources import frontier as fr
from postlake.sources import sinks
from postlake.sources.scan import scan_drifting_tree, scan_parquet_tree
from postlake.sources.tables import read_table as read
from postlake.sources.tables import spread


# ---------------------------------------------------------------- parameters
# Query parameters (chosen once; the library defaults follow the reference).
PREFIX_WORDS = 2
TOP_K = 10
PART_CATEGORY_RULES = [
    ("rings", ["ring"]),
    ("red items", ["red"]),
    ("widgets", ["widget"]),
    ("bolts", ["bolt"]),
]
PART_REMOTE_WORDS = ["small"]
PART_CATEGORY_COORDS = [("rings", -34.61, -58.38), ("red items", -31.42, -64.18), ("widgets", -32.89, -68.84)]
PART_MODALITY_RULES = [("Economy", ["economy"]), ("Large", ["large", "big"]), ("Small", ["small"])]
PART_TAG_WORDS = ["red", "blue"]
TEST_BLOCK_PHRASES = BLOCK_PHRASES + ["spam-farm"]
CONTAINS_WORD = "DOS"
CONTAINS_REGEX = r"\b[a-z]+@[a-z]+\.|[0-9]{2,}\.[0-9]+"


# ---------------------------------------------------------------- queries
def top_tokens(spark, sf_dir):
    """Most frequent non-stopword tokens of the texts."""
    docs = spread(read(spark, sf_dir, "documents").select("text"))
    return analysis.top_title_tokens(spark, docs, "text", TOP_K, count_col="freq")


def lineitem_top_parts(spark, sf_dir):
    """A2 K1 A6 A7 on the largest table: the most frequent parts over all
    line items with their share of the top-k."""
    lines = read(spark, sf_dir, "lineitem").select("l_partkey")
    freq = frequency.value_counts(lines, "l_partkey", "freq")
    out = frequency.top_k_share(freq, "l_partkey", TOP_K, "freq", "share", "top_total")
    return out.withColumn("share", F.round("share", 6))


def title_prefix_topk_share(spark, sf_dir):
    """Top first-n-word prefixes with their share of the top-k."""
    docs = spread(read(spark, sf_dir, "documents").select("text"))
    out = analysis.top_title_prefixes(docs, "text", PREFIX_WORDS, TOP_K, count_col="freq")
    return out.withColumn("share", F.round("share", 6))


def category_counts_coords(spark, sf_dir):
    """Rule-normalised categories, counts and coordinates."""
    part = read(spark, sf_dir, "part").select("p_name")
    return analysis.demand_by_province(
        spark, part, "p_name", PART_CATEGORY_COORDS, PART_CATEGORY_RULES, PART_REMOTE_WORDS,
        key_col="category", count_col="freq",
    )


def category_rules_table(spark, sf_dir):
    """J2 (rule-table form) A1: categories from a priority-ordered keyword table, counted."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    rules = [(i, cat, kw) for i, (cat, kws) in enumerate(PART_CATEGORY_RULES) for kw in kws]
    tagged = lookup.categorize_by_rules(part, "p_name", rules, "category")
    return frequency.group_count(tagged, "category", "freq")


def category_rules_indexed(spark, sf_dir):
    """J2 (large rule table): the second word of every document is a keyword, the
    smallest doc_id its priority and that document's source its category; every
    page's URL gets the category of its first keyword."""
    words = F.regexp_extract("text", "^[^ \\n]+ ([^ \\n]+)", 1)
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("priority"), F.col("source").alias("category"), words.alias("keyword"))
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return lookup.categorize_by_rule_table(pages, "url", docs).select("page_id", "category")


def normalize_text(spark, sf_dir):
    """X1 X2 X3 on whole texts."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", pf.remove_noise(pf.strip(pf.lower("text"))).alias("norm_text"))


def title_case(spark, sf_dir):
    """P3 P4 P6 over part names and whole document texts."""
    part = read(spark, sf_dir, "part").select(
        F.lit("part").alias("src"), F.col("p_partkey").alias("id"), F.col("p_name").alias("raw")
    )
    docs = read(spark, sf_dir, "documents").select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("id"), F.col("text").alias("raw")
    )
    both = spread(part.unionByName(docs))
    titled = both.select("src", "id", pf.title_case(pf.strip("raw")).alias("title"))
    return titled.withColumn("title_lower", F.lower("title"))


def job_key(spark, sf_dir):
    """Business key from url, first <h1> and host."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    t = pages.select(
        "page_id", "url", ph.first_tag_text("html", "h1").alias("title"), pf.host("url").alias("company")
    )
    return t.select("page_id", "title", "company", pf.job_key("url", "title", "company").alias("job_key"))


def dedup_by_key(spark, sf_dir):
    """First document (by doc_id) per SHA-256 of its text."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    keyed = docs.select("doc_id", F.sha2("text", 256).alias("dedup_key"), "lang")
    return dedup.keep_first(keyed, ["dedup_key"], ["doc_id"])


def _links(pages: DataFrame) -> DataFrame:
    exploded = pages.select(
        "page_id", pf.origin("url").alias("base"), F.explode_outer(ph.hrefs("html")).alias("href")
    ).where("href is not null")  # outer: an inner explode works out its array once more, to filter on its size
    return exploded.select("page_id", pf.absolute_url("href", F.col("base")).alias("link"))


def dedup_across_runs(spark, sf_dir):
    """A8 across runs: the orders of 2001, one a customer and priority, without
    those that the stored layer of the two years before holds for the same status."""
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy").alias("ds"), F.col("o_orderstatus").alias("source")
    )
    base = shared_dir(spark, "stored-orders")
    sinks.write_layer(orders.where("ds < '2001'"), base)
    keys = ["source", "o_custkey", "o_orderpriority"]
    today = dedup.keep_first(orders.where("ds = '2001'"), keys, ["o_orderkey"])
    stored = sinks.read_layer(spark, base, orders.schema).where("ds >= '1999' and ds < '2001'")
    return dedup.drop_stored(today, stored, keys).drop("ds")


def dedup_links(spark, sf_dir):
    """Distinct absolute links found in the pages."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return dedup.distinct_values(_links(pages), "link")


def _articles(pages: DataFrame) -> DataFrame:
    """Every page of the test tables as an article: none is of a known site."""
    return pages.withColumn("source", postings.source_of(F.col("url"), default="article"))


def page_titles(spark, sf_dir):
    """First <h1> text per page."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", ph.first_tag_text("html", "h1").alias("title"))


def blocked_pages(spark, sf_dir):
    """Crawl statistics per language section of the site."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    named = pages.withColumn("section", F.regexp_extract("url", r"://[^/]+/([a-z]{2})/", 1))
    has_title = ph.first_tag_text("html", "h1").isNotNull()
    return postings.crawl_stats(named, ["section"], TEST_BLOCK_PHRASES, None, has_title)


def _event_pages(events: DataFrame) -> DataFrame:
    js = F.concat(
        F.lit('{"@type": "JobPosting", "title": "'), F.col("event_type"), F.lit(" #"),
        F.col("event_id").cast("string"),
        F.lit('", "hiringOrganization": {"name": "user '), F.col("user_id").cast("string"),
        F.lit('"}, "jobLocation": {"address": {"addressLocality": "'), F.upper("event_type"),
        F.lit('"}}, "datePosted": "'), F.date_format("ts", "yyyy-MM-dd"),
        F.lit('", "props": '), F.col("props"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}")),
    )
    html = F.concat(
        F.lit('<html><head><script type="application/ld+json">'), js,
        F.lit("</script></head><body><h1>"), F.col("event_type"), F.lit(" page "),
        F.col("event_id").cast("string"), F.lit("</h1></body></html>"),
    )
    return events.select("event_id", html.alias("html"))


def jsonld_fields(spark, sf_dir):
    """JS1 JS2 X20: JSON-LD fields with the <h1> fallback for the title."""
    events = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    pages = _event_pages(spread(events))
    parsed = pages.select("event_id", "html", ph.jsonld_value(ph.jsonld_block("html")).alias("ld"))
    return parsed.select(
        "event_id",
        pf.first_nonempty(ph.jsonld_get("ld", "title"), ph.first_tag_text("html", "h1")).alias("title"),
        ph.jsonld_get("ld", "company").alias("company"),
        ph.jsonld_get("ld", "location").alias("location"),
        ph.jsonld_get("ld", "date_posted").alias("posted_date"),
        F.col("ld").isNotNull().alias("jsonld_ok"),
    )


def modality_class(spark, sf_dir):
    """Ordered keyword classes and first matching tag."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    tags = F.split("p_name", " ")
    return part.select(
        "p_partkey",
        pf.classify_contains(F.concat_ws(" ", "p_type", "p_name"), PART_MODALITY_RULES, "Otros").alias("modality"),
        pf.any_contains(tags, PART_TAG_WORDS).alias("has_tag_word"),
        pf.first_matching(tags, PART_TAG_WORDS).alias("first_tag"),
    )


def split_company_location(spark, sf_dir):
    """X9 with separator '-'."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    head, last = pf.split_last("o_orderpriority", "-")
    return orders.select("o_orderkey", head.alias("company"), last.alias("location"))


def first_int(spark, sf_dir):
    """X7 over customer names."""
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return cust.select("c_custkey", pf.first_int("c_name").alias("first_int"))


def first_date(spark, sf_dir):
    """First d/m/yyyy in a text and the yyyy-MM-dd run date."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    text = F.concat(
        F.lit("Pedido "), F.col("o_orderkey").cast("string"), F.lit(" publicado el "),
        F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" (ref 12/345)"),
    )
    return orders.select(
        "o_orderkey",
        pf.first_date(text).alias("posted_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ds"),
        pf.today_ds().alias("run_ds"),
    )


def salary_string(spark, sf_dir):
    """Range and currency strings only when both parts exist."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    lo = F.when(F.col("p_type") != "ECONOMY", F.col("p_size"))
    hi = F.col("p_retailprice").cast("decimal(12,2)")
    unit = F.when(F.col("p_size") <= 25, F.lit("month"))
    return part.select(
        "p_partkey",
        pf.range_string(lo, hi, " - ").alias("salary"),
        pf.range_string(F.col("p_brand"), unit, "/").alias("salary_currency"),
        pf.flag_phrase("p_name", "ring", "A Convenir").alias("negotiable"),
    )


def canonical_url(spark, sf_dir):
    """Canonical id URL, slug, safe name and site settings."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    t = pages.select(
        "page_id", "url", pf.origin("url").alias("base"), pf.host("url").alias("host"),
        ph.first_tag_text("html", "h1").alias("title"),
    )
    sites = lookup.small_table(spark, list(SITE_MAX_PAGES.items()), "site_key string, site_max_pages int")
    keyed = t.select(
        "page_id",
        pf.canonical_by_param("url", F.col("base"), "page", "/viewjob").alias("canonical"),
        pf.slug("title").alias("slug"),
        pf.safe_name("title").alias("safe_name"),
        pf.site_key("host").alias("site_key"),
    )
    joined = lookup.attach(keyed, sites, "site_key")
    return joined.select(
        "page_id", "canonical", "slug", "safe_name", "site_key",
        F.coalesce("site_max_pages", F.lit(DEFAULT_MAX_PAGES)).alias("max_pages"),
    )


def null_profile(spark, sf_dir):
    """A3 A4 A5: null profile of documents left-joined with labels."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return profile.null_profile(docs.join(labels, "doc_id", "left"))


def contains_filters(spark, sf_dir):
    """Equality, contains and regex search (null never matches), one scan for both filters."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    word = (F.col("lang") == "es") & analysis.keyword_hit("text", CONTAINS_WORD)
    return analysis.label_hits(docs, {"word": word, "regex": analysis.keyword_hit("text", CONTAINS_REGEX, regex=True)}, "hit").select("doc_id", "lang", "hit")


def list_ops(spark, sf_dir):
    """List cleaning, union, join and first match."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    a = pf.clean_list(F.split("p_name", " "), ["no"])
    b = pf.clean_list(F.array("p_brand", "p_type", F.lit(" "), F.lit("No")), ["no"])
    skills = pf.set_union(a, b)
    return part.select("p_partkey", skills.alias("s")).select(
        "p_partkey",
        pf.join_lines("s").alias("skills"),
        F.size("s").alias("n_skills"),
        pf.first_matching("s", ["ring", "bolt"]).alias("first_hit"),
    )


def union_by_name(spark, sf_dir):
    """Two sources conformed to one schema, missing → null."""
    fields = [("id", T.LongType()), ("name", T.StringType()), ("nationkey", T.IntegerType()), ("acctbal", T.DoubleType()), ("segment", T.StringType())]
    cust = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("source"),
    )
    supp = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("source"),
    )
    return postings.conform(cust, fields).unionByName(postings.conform(supp, fields))


def head_preview(spark, sf_dir):
    """K2: first five orders by key."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return frequency.head(orders, ["o_orderkey"], 5)


def links_join_pages(spark, sf_dir):
    """Distinct link list joined to the fetched pages by URL (fragment
    dropped); the HTML itself stays out of the shuffle."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    link_of = F.regexp_replace("url", "#.*$", "")
    links = dedup.distinct_values(pages.select(link_of.alias("link")), "link")
    fetched = pages.select(
        "page_id", link_of.alias("link"), ph.first_tag_text("html", "h1").alias("title"),
        F.length("html").alias("html_chars"),
    )
    return links.join(fetched, "link", "inner")


def link_outcomes(spark, sf_dir):
    """The links found in all pages and in one landed listing
    page an event, against the fetched pages: ``pages`` and one detail page a
    customer (none for BUILDING). Listing links carry tracking parameters."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("source", F.lit("article"))
    site = SITE_BASE_URLS["indeed"]
    detail = lambda key, *rest: F.concat(F.lit("/viewjob?jk="), key.cast("string"), *rest)
    listing = read(spark, sf_dir, "events").select(
        F.concat(F.lit(f"{site}/jobs?start="), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.lit('<a href="'), detail(F.col("user_id"), F.lit("&amp;from="), F.col("event_type")), F.lit('">x</a>')).alias("html"),
        F.lit("indeed").alias("source"),
    )
    found = pages.drop("page_id").unionByName(listing).select("source", pf.origin("url").alias("base"), F.explode_outer(ph.hrefs("html")).alias("href"))
    links = found.where("href is not null").select("source", pf.absolute_url("href", F.col("base")).alias("link"))
    fetched = read(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("page_id"), F.concat(F.lit(site), detail(F.col("c_custkey"), F.lit("&tk=1"))).alias("url"), F.lit("indeed").alias("source")
    )
    return fr.link_outcomes(links, pages.select("page_id", "url", "source").unionByName(fetched))


def _by_domain(pages: DataFrame) -> tuple[DataFrame, dict]:
    """Pages with the last part of their host as source, and article rules, for two of those; null for others."""
    rules = {s: EXTRACTION_RULES["article"] for s in ("com", "org")}
    domain = F.element_at(F.split(pf.host("url"), r"\."), -1)
    return pages.withColumn("source", F.when(domain.isin(list(rules)), domain)), rules


def committed_run(spark, sf_dir):
    """Two days and a rerun of the first with longer pages only, each
    one commit; a third day is staged and never committed. The counters read
    back are those of the last commits."""
    pages, rules = _by_domain(spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"), always=True))
    base = shared_dir(spark, "committed")
    args = {"rules": rules, "extractor": extract_flat}
    postings.run_committed(spark, pages, "2024-01-01", base, **args)
    postings.run_committed(spark, pages, "2024-01-02", base, **args)
    longer = pages.where((F.length("html") >= 2000) & (F.col("source") == "com"))
    postings.run_committed(spark, longer, "2024-01-01", base, **args)
    staged = [sinks.version_path(base, layer, sinks.new_version()) for layer in ("raw", "processed", "counters")]
    postings.run(spark, pages, "2024-01-02", *staged[:2], **args, counters_path=staged[2])
    rows = sinks.read_committed(spark, base, "processed", postings.PROCESSED_SCHEMA)
    return rows.select("ds", "source", "page_id", "url", "title")


def crawl_counters(spark, sf_dir):
    """The counters per (ds, source) that one run stores; pages of
    other hosts are skipped."""
    pages, rules = _by_domain(spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"), always=True))
    base = shared_dir(spark, "counters")
    postings.run(spark, pages, "2024-01-01", f"{base}/raw", f"{base}/processed", rules, extractor=extract_flat, counters_path=f"{base}/counters")
    return sinks.read_layer(spark, f"{base}/counters", postings.COUNTERS_SCHEMA)


def frontier(spark, sf_dir):
    """Listing URLs per region and source, pages 1..max."""
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return fr.listing_urls(
        region, "r_name", "Argentina", all_listing_sources=list(ALL_LISTING_TEMPLATES)
    ).select("r_regionkey", "source", "page", "url")


def frontier_from_titles(spark, sf_dir):
    """Listing URLs for search texts mined from the data — the
    distinct first two words of every document and every part name — on every
    site and page (the frontier grows with the data). Search texts are made
    distinct before sites and pages are exploded."""
    docs = spread(read(spark, sf_dir, "documents").select("text")).select(pf.first_words("text", PREFIX_WORDS).alias("q"))
    names = read(spark, sf_dir, "part").select(F.col("p_name").alias("q"))
    searches = dedup.distinct_values(docs.unionByName(names), "q")
    return fr.listing_urls(searches, "q", "Argentina").select("source", "page", "url").distinct()


def listing_links(spark, sf_dir):
    """Distinct detail links per source found in the navigation lists."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"), always=True)
    return fr.detail_links(_articles(pages), extractor=extract_flat)


def roundtrip_sinks(spark, sf_dir):
    """Write a layer twice plus an empty rerun, read back."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    stamped = orders.select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.date_format(F.date_trunc("year", "o_orderdate"), "yyyy-MM-dd").alias("ds"),
        F.col("o_orderstatus").alias("source"),
    )
    base = shared_dir(spark, "roundtrip")
    sinks.write_layer(stamped, base)
    sinks.write_layer(stamped, base)
    sinks.write_layer(stamped.where(F.lit(False)), base)  # an empty rerun changes nothing
    return sinks.read_layer(spark, base, stamped.schema)


def recursive_scan(spark, sf_dir):
    """A foreign tree — files at different depths with different
    columns — read back recursively with columns unioned by name."""

    orders = read(spark, sf_dir, "orders")
    base = shared_dir(spark, "foreign-tree")
    done = F.col("o_orderstatus") == "F"
    orders.where(done).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus") \
        .write.parquet(f"{base}/finished")
    orders.where(~done).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority") \
        .write.parquet(f"{base}/open/2024-01-01")
    return scan_parquet_tree(spark, base).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )


def drifting_scan(spark, sf_dir):
    """S1 with drift in one folder: the priority is text in some files and a list
    in others, the customer a number and text, the price missing from some."""
    orders = read(spark, sf_dir, "orders")
    base = shared_dir(spark, "drifting-tree")
    done = F.col("o_orderstatus") == "F"
    orders.where(done).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.parquet(f"{base}/orders")
    parts = F.split("o_orderpriority", "-").alias("o_orderpriority")
    orders.where(~done).select(F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("string"), parts) \
        .write.mode("append").parquet(f"{base}/orders")
    return scan_drifting_tree(spark, base).select(
        "o_orderkey", "o_custkey", "o_totalprice", F.array_join("o_orderpriority", "|").alias("priority")
    )


def observe_counts(spark, sf_dir):
    """Row counts at two points of a plan, collected by one Observation."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    counts = count_stages(part, [("scanned", None), ("kept", F.col("p_size") > 10)])
    return spark.createDataFrame(counts, "stage string, rows bigint")


def extract_rules(spark, sf_dir):
    """Native extraction of every page as an article, lists
    emitted as newline-joined strings."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"), always=True)
    out = postings.extract_postings(_articles(pages), keep_errors=True, extractor=extract_flat)
    return out.select(
        "page_id", "title", "company", "location",
        F.array_join("tags", "\n").alias("tags"),
        F.array_join("skills", "\n").alias("skills"),
        "parse_ok",
    )


def postings_daily_run(spark, sf_dir):
    """S3 S4 P1-P7 A8 G3 H*: pages → raw layer → processed layer for one ds."""
    pages = spread(read(spark, sf_dir, "pages").select("page_id", "url", "html"), always=True)
    base = shared_dir(spark, "daily-run")
    out = postings.run(spark, _articles(pages), "2024-01-01", f"{base}/raw", f"{base}/processed", extractor=extract_flat)
    return out.select(
        "job_key", "title", "title_lower", "company", "location", "posted_date", "url",
        F.length("description_raw").alias("description_chars"),
        F.array_join("tags", "\n").alias("tags"), F.array_join("skills", "\n").alias("skills"),
        "source_site", "source", "ds",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **site_pages.QUERIES,
    "top_tokens": top_tokens,
    "title_prefix_topk_share": title_prefix_topk_share,
    "lineitem_top_parts": lineitem_top_parts,
    "category_counts_coords": category_counts_coords,
    "category_rules_table": category_rules_table,
    "category_rules_indexed": category_rules_indexed,
    "normalize_text": normalize_text,
    "title_case": title_case,
    "job_key": job_key,
    "dedup_by_key": dedup_by_key,
    "dedup_across_runs": dedup_across_runs,
    "dedup_links": dedup_links,
    "page_titles": page_titles,
    "blocked_pages": blocked_pages,
    "jsonld_fields": jsonld_fields,
    "modality_class": modality_class,
    "split_company_location": split_company_location,
    "first_int": first_int,
    "first_date": first_date,
    "salary_string": salary_string,
    "canonical_url": canonical_url,
    "null_profile": null_profile,
    "contains_filters": contains_filters,
    "list_ops": list_ops,
    "union_by_name": union_by_name,
    "head_preview": head_preview,
    "links_join_pages": links_join_pages,
    "link_outcomes": link_outcomes,
    "frontier": frontier,
    "frontier_from_titles": frontier_from_titles,
    "listing_links": listing_links,
    "roundtrip_sinks": roundtrip_sinks,
    "observe_counts": observe_counts,
    "recursive_scan": recursive_scan,
    "drifting_scan": drifting_scan,
    "extract_rules": extract_rules,
    "postings_daily_run": postings_daily_run,
    "committed_run": committed_run,
    "crawl_counters": crawl_counters,
}
