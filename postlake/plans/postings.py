"""The posting pipeline: pages → typed postings → raw layer → processed layer.

    pages(page_id, url, html[, source])
      │ F1 drop failed pages, source by host (S5), F2 blocked flag (indeed)
      ▼ extraction job (mapInPandas, rules as data)          [Python worker]
    inputs map ─ native assembly per source (X7-X21, JS2, K3, H10, A10)
      ▼ canonical 15 fields (P7) + metadata (P1) + job_key (P2)
    raw layer  (partitioned ds/source, dynamic overwrite)    [S3]
      ▼ read back (no second parse)
    transform: strip/title/lower (P3-P6) + keyed dedup (A8)
    processed layer (ds/source)                              [S4, G3 fixed]
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake import functions as pf
from postlake.functions import html as ph
from postlake.operators import dedup
from postlake.operators.extract import extract_pages
from postlake.rules import sites
from postlake.rules.extraction import EXTRACTION_RULES, REPAIR_SOURCES, SOURCE_HOSTS
from postlake.sources import sinks

# Canonical parsed fields and their types (§1 of the blueprint).
POSTING_FIELDS: list[tuple[str, T.DataType]] = [
    ("title", T.StringType()),
    ("company", T.StringType()),
    ("location", T.StringType()),
    ("salary", T.StringType()),
    ("salary_currency", T.StringType()),
    ("job_type", T.StringType()),
    ("modality", T.StringType()),
    ("experience_level", T.StringType()),
    ("posted_date", T.StringType()),
    ("url", T.StringType()),
    ("description_raw", T.StringType()),
    ("tags", T.ArrayType(T.StringType())),
    ("skills", T.ArrayType(T.StringType())),
    ("source_site", T.StringType()),
    ("applicants", T.IntegerType()),
]
META_FIELDS: list[tuple[str, T.DataType]] = [
    ("source", T.StringType()),
    ("ds", T.StringType()),
    ("scraped_at", T.TimestampType()),
    ("job_key", T.StringType()),
    ("page_id", T.LongType()),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t) for n, t in POSTING_FIELDS + META_FIELDS])
PROCESSED_SCHEMA = T.StructType(list(RAW_SCHEMA.fields) + [T.StructField("title_lower", T.StringType())])

# What a run counts, per source and in all
COUNTERS = ("links", "processed", "blocked", "parsed", "errors", "processed_rows")
COUNTERS_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in COUNTERS] + [T.StructField(n, T.StringType()) for n in sinks.PARTITION_COLS])

SOURCE_SITE_NAMES = {"getonboard": "get_on_board"}  # G6: as each site labels itself
log = logging.getLogger("postlake")


# ------------------------------------------------------------------ helpers
def _v(name: str) -> Column:
    return F.try_element_at(F.try_element_at(F.col("inputs"), F.lit(name)), F.lit(1))


def _l(name: str) -> Column:
    return F.coalesce(F.try_element_at(F.col("inputs"), F.lit(name)), F.array().cast("array<string>"))


def _one(c: Column) -> Column:
    """Scalar → one-element list; null → empty list (type drift, §1)."""
    return F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))


def source_of(url: Column, known: Mapping[str, str] = SOURCE_HOSTS, default: str | None = None) -> Column:
    """Site key from the detail-page host; unknown hosts get ``default``
    (null: their pages are skipped by ``extract_postings``)."""
    h = pf.host(url)
    expr = None
    for hostname, src in known.items():
        cond = h == hostname
        expr = F.when(cond, F.lit(src)) if expr is None else expr.when(cond, F.lit(src))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def conform(df: DataFrame, fields: Sequence[tuple[str, T.DataType]] = POSTING_FIELDS) -> DataFrame:
    """P5 + P7: project to the canonical fields, casting; absent → typed null."""
    cols = []
    for name, dtype in fields:
        if name in df.columns:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    extra = [c for c in df.columns if c not in {n for n, _ in fields}]
    return df.select(*cols, *extra)


def conform_drifted(df: DataFrame, fields: Sequence[tuple[str, T.DataType]] = POSTING_FIELDS + META_FIELDS) -> DataFrame:
    """Canonical types for rows written by another tool (§1 type drift): a
    scalar where a list belongs becomes a one-element list, text becomes int
    or timestamp with ``try_`` casts, absent fields are typed nulls. Extra
    columns are kept."""
    have = dict(df.dtypes)
    cols = []
    for name, dtype in fields:
        if name not in have:
            cols.append(F.lit(None).cast(dtype).alias(name))
            continue
        c = F.col(name)
        if isinstance(dtype, T.ArrayType) and not have[name].startswith("array"):
            expr = F.when(c.isNotNull(), F.array(c.cast("string")))
        elif isinstance(dtype, T.TimestampType) and have[name] == "string":
            expr = F.try_to_timestamp(c)
        elif have[name] == "string" and not isinstance(dtype, T.StringType):
            expr = c.try_cast(dtype)
        else:
            expr = c.cast(dtype)
        cols.append(expr.alias(name))
    extra = [F.col(c) for c in df.columns if c not in {n for n, _ in fields}]
    return df.select(*cols, *extra)


def read_foreign_layer(spark: SparkSession, base_path: str) -> DataFrame:
    """S1 + §1: read a layer written by the reference's pandas job (one folder
    per source, drifting types) into the canonical posting schema."""
    from postlake.sources.scan import scan_tree_by_folder

    return scan_tree_by_folder(spark, base_path, conform_drifted)


# ---------------------------------------------------------------- assembly
def _assemble_exprs() -> dict[str, dict[str, Column]]:
    mod = lambda c: pf.classify_contains(c, sites.MODALITY_RULES, sites.MODALITY_DEFAULT)
    ld = F.col("__ld")  # variant, parsed once per page
    line = _v("company_line")
    head, last = pf.split_last(line, " - ")
    tags_ct = _l("tags")
    job_enum = None
    for label in sites.JOB_TYPE_HEADINGS:
        cond = F.array_contains(_l("job_type_strings"), label)
        job_enum = F.when(cond, F.lit(label)) if job_enum is None else job_enum.when(cond, F.lit(label))
    # first availability text naming a known schedule (later labels are tried too)
    avail = F.lower(pf.first_matching(_l("availability"), [n for n, _ in sites.JOB_TYPE_AVAILABILITY]))
    avail_enum = None
    for needle, label in sites.JOB_TYPE_AVAILABILITY:
        cond = F.contains(avail, F.lit(needle))
        avail_enum = F.when(cond, F.lit(label)) if avail_enum is None else avail_enum.when(cond, F.lit(label))
    return {
        "getonboard": {
            "title": _v("title"), "company": _v("company"), "location": _v("location"),
            "salary": pf.range_string(_v("salary_min"), _v("salary_max"), " - "),
            "salary_currency": pf.range_string(_v("salary_currency"), _v("salary_unit"), "/"),
            "job_type": job_enum, "modality": mod(_v("modality_text")),
            "experience_level": _v("experience"), "posted_date": _v("posted_date"),
            "description_raw": pf.join_lines(_l("description")),
            "tags": _l("tags"), "skills": pf.set_union(_l("skills_a"), _l("skills_b")),
            "applicants": pf.first_int(_v("applicants_text")),
        },
        "zonajobs": {
            "title": _v("title"), "company": _v("company"), "location": _v("location"),
            "salary_currency": F.lit(sites.DEFAULT_CURRENCY),
            "job_type": _v("job_type"), "modality": mod(_v("modality_text")),
            "experience_level": _v("experience"), "posted_date": _v("posted_date"),
            "description_raw": _v("description"), "tags": _one(_v("tags")), "skills": _one(_v("skills")),
        },
        "indeed": {
            "title": pf.first_nonempty(ph.jsonld_get(ld, "title"), _v("title")),
            "company": pf.first_nonempty(ph.jsonld_get(ld, "company"), _v("company")),
            "location": pf.first_nonempty(ph.jsonld_get(ld, "location"), _v("location")),
            "job_type": ph.jsonld_get(ld, "employment_type"),
            "posted_date": ph.jsonld_get(ld, "date_posted"),
            "description_raw": pf.first_nonempty(ph.jsonld_get(ld, "description"), _v("description")),
            "skills": F.array().cast("array<string>"),
        },
        "computrabajo": {
            "title": _v("title"),
            "company": F.when(line.isNotNull() & (line != ""), head),
            "location": F.when(F.contains(line, F.lit(" - ")), last).otherwise(_v("location_fallback")),
            "salary": _v("salary"), "salary_currency": F.lit(sites.DEFAULT_CURRENCY),
            "job_type": pf.first_matching(tags_ct, sites.JOB_TYPE_TAG_WORDS),
            "modality": pf.first_matching(tags_ct, sites.MODALITY_TAG_WORDS),
            "posted_date": _v("posted_date"),
            "description_raw": F.when(
                F.size(_l("description_parts")) > 0,
                F.array_join(F.filter(_l("description_parts"), lambda x: x != ""), "\n"),
            ).otherwise(_v("description_fallback")),
            "tags": tags_ct, "skills": pf.set_union(_l("skills_a"), _l("skills_b")),
        },
        "portal_empleo": {
            "title": _v("title"), "company": _v("company"), "location": _v("location"),
            "salary": pf.flag_phrase(F.col("page_text"), sites.NEGOTIABLE_PHRASE, sites.NEGOTIABLE_LABEL),
            "salary_currency": F.lit(sites.DEFAULT_CURRENCY),
            "job_type": avail_enum, "modality": mod(F.coalesce(_v("location"), F.lit(""))),
            "experience_level": _v("experience"),
            "posted_date": pf.first_nonempty(_v("posted_date"), pf.first_date(F.col("page_text"))),
            "description_raw": _v("description"), "tags": _l("tags"), "skills": _l("skills"),
        },
        "article": {
            "title": _v("title"), "company": pf.host("url"), "location": _v("location"),
            "posted_date": pf.first_date(F.col("page_text")),
            "description_raw": pf.join_lines(_l("description_parts")),
            "tags": _l("tags"), "skills": pf.set_union(_l("skills")),
        },
    }


def _by_name(name: str, dtype: T.DataType) -> Column:
    """A field read straight from the input of the same name (null when the
    rule set has none) — how a new source is added with rules alone."""
    if isinstance(dtype, T.ArrayType):
        return F.try_element_at(F.col("inputs"), F.lit(name))
    return _v(name).try_cast(dtype)


def assemble(extracted: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Inputs → the 15 canonical fields, one ``CASE`` per field over sources;
    fields a source does not assemble come from the input of the same name."""
    per_source = _assemble_exprs()
    cols = []
    for name, dtype in POSTING_FIELDS:
        if name == "url":
            cols.append(F.col("url"))
            continue
        if name == "source_site":
            expr = F.col("source")
            for src, label in SOURCE_SITE_NAMES.items():
                expr = F.when(F.col("source") == src, F.lit(label)).otherwise(expr)
            cols.append(expr.alias(name))
            continue
        expr = None
        for src, exprs in per_source.items():
            if name in exprs:
                cond = F.col("source") == src
                expr = F.when(cond, exprs[name]) if expr is None else expr.when(cond, exprs[name])
        fallback = _by_name(name, dtype)
        expr = fallback if expr is None else expr.otherwise(fallback)
        # A page that failed to parse keeps only url / site and empty lists
        empty = F.array().cast(dtype) if isinstance(dtype, T.ArrayType) else F.lit(None).cast(dtype)
        expr = F.when(F.col("parse_ok"), expr).otherwise(empty)
        cols.append(expr.cast(dtype).alias(name))
    return extracted.select(*cols, "source", "page_id", "parse_ok", "parse_error", "__keep", *carry)


def counted(name: str, rows: Column, sources: Iterable[str]) -> list[Column]:
    """Counter ``name`` of the rows, in all and per source: a fixed number of
    sums for ``observe``, as many as there are sources with rules."""
    return [F.count_if(rows).alias(name), *[F.count_if(rows & (F.col("source") == s)).alias(f"{name}:{s}") for s in sources]]


def extract_postings(
    pages: DataFrame,
    rules: Mapping[str, Sequence] = EXTRACTION_RULES,
    block_phrases: Sequence[str] = sites.BLOCK_PHRASES,
    blocked_sources: Sequence[str] = ("indeed",),
    keep_errors: bool = False,
    observations: dict | None = None,
    carry: Sequence[str] = (),
    extractor: Callable = extract_pages,
) -> DataFrame:
    """pages → canonical posting rows (plus ``source``, ``page_id``,
    ``parse_ok``, ``parse_error``).

    S5 skips pages without a source, as those of unknown hosts are (their number
    is observed as ``skipped``); a named source without rules is a failed parse. F1 drops null/empty pages; F2 drops blocked pages of ``blocked_sources``
    before any parsing; F3 drops indeed pages with neither JSON-LD nor a
    description. Failed parses are dropped unless ``keep_errors`` (H11).
    Pass a dict as ``observations`` to get A11/S8 counters (``pages``,
    ``output``) filled by whatever action runs the plan — no extra job.
    ``extractor`` is the rule mapper, or ``operators.flat.extract_flat`` where
    all pages are articles. ``carry`` names small page columns (e.g. ``ds``) passed through unchanged.
    """
    src = pages if "source" in pages.columns else pages.withColumn("source", source_of(F.col("url")))
    failed = F.col("html").isNull() | (F.col("html") == "")
    blocked = F.col("source").isin(list(blocked_sources)) & ph.is_blocked("html", block_phrases)
    known = F.col("source").isNotNull()
    if observations is not None:
        observations["pages"] = Observation("pages")
        src = src.observe(
            observations["pages"],
            F.count_if(~known).alias("skipped"),
            *counted("links", known, rules),
            *counted("processed", known, rules),
            *counted("blocked", known & (failed | blocked), rules),
        )
    src = src.where(known & ~failed & ~blocked)
    joined = extractor(
        src.select("page_id", "source", "url", "html", *carry), rules, passthrough=list(carry),
        repair_sources=sorted(REPAIR_SOURCES),
    )
    with_ld = joined.withColumn("__ld", ph.jsonld_value(_v("jsonld"))).withColumn(
        "__keep",
        F.when(
            F.col("source") == "indeed",
            ph.jsonld_holds_fields("__ld") | _v("has_description").isNotNull(),
        ).otherwise(F.lit(True)),
    )
    out = assemble(with_ld, carry).where(F.col("__keep")).drop("__keep")
    if not keep_errors:
        out = out.where(F.col("parse_ok"))
    if observations is not None:
        observations["output"] = Observation("output")
        out = out.observe(
            observations["output"],
            *counted("parsed", F.col("parse_ok"), rules),
            *counted("errors", ~F.col("parse_ok"), rules),
        )
    return out


def crawl_stats(
    pages: DataFrame,
    by: Sequence[str] = ("source",),
    block_phrases: Sequence[str] = sites.BLOCK_PHRASES,
    blocked_sources: Sequence[str] | None = ("indeed",),
    parsed: Column | None = None,
) -> DataFrame:
    """Links, processed, blocked and parsed pages per group.

    Every link counts as processed; a page is blocked if it is empty or, for
    the ``blocked_sources`` (None: all), holds a block phrase; it is parsed if
    it is not blocked and ``parsed`` holds (default: any page). One
    partial+final hash aggregate; the HTML is read once and never shuffled."""
    src = pages if "source" in pages.columns else pages.withColumn("source", source_of(F.col("url")))
    empty = F.col("html").isNull() | (F.col("html") == "")
    phrase = ph.is_blocked("html", block_phrases)
    if blocked_sources is not None:
        phrase = F.coalesce(F.col("source").isin(list(blocked_sources)), F.lit(False)) & phrase
    flags = src.select(*by, (empty | phrase).alias("blocked"), (parsed if parsed is not None else F.lit(True)).alias("ok"))
    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("links"),
        F.count(F.lit(1)).alias("processed"),
        F.count_if("blocked").alias("blocked"),
        F.count_if(~F.col("blocked") & F.col("ok")).alias("parsed"),
    )


def stamp(df: DataFrame, ds: str | Column, scraped_at: Column | None = None) -> DataFrame:
    """P1 + P2: ``ds``, ``scraped_at`` and the business key on raw values."""
    ds_col = F.lit(ds) if isinstance(ds, str) else ds
    return df.withColumns(
        {
            "ds": ds_col,
            "scraped_at": scraped_at if scraped_at is not None else F.current_timestamp(),
            "job_key": pf.job_key("url", "title", "company"),
        }
    )


def transform(df: DataFrame, scope: Sequence[str] = ("ds", "source")) -> DataFrame:
    """P3-P6 + A8: strip/title-case title, strip company/location, keep the
    first row per ``job_key`` within ``scope`` (G4 order), add ``title_lower``."""
    df = conform(df, POSTING_FIELDS + META_FIELDS)
    cleaned = df.withColumns(
        {
            "title": pf.title_case(pf.strip("title")),
            "company": pf.strip("company"),
            "location": pf.strip("location"),
        }
    )
    # Full order: a rerun or a retried task must pick the same winner. The hash
    # of the row, without its time stamp, decides between rows without a page id.
    content = [c for c in cleaned.columns if c != "scraped_at"]
    order = ["scraped_at", "url", "page_id", "title", "company", "location", F.xxhash64(*content)]
    kept = dedup.keep_first(cleaned, [*scope, "job_key"], order)
    return kept.withColumn("title_lower", F.lower("title"))


def drop_seen(spark: SparkSession, rows: DataFrame, processed_path: str, ds: str, days: int) -> DataFrame:
    """A8 across runs: ``rows`` without the postings that the processed layer
    holds for the same source in the ``days`` days before ``ds``."""
    since = (date.fromisoformat(ds) - timedelta(days=days)).isoformat()
    try:
        stored = sinks.read_layer(spark, processed_path, PROCESSED_SCHEMA)
    except AnalysisException as exc:  # the first run has no layer yet
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows
    earlier = stored.where((F.col("ds") >= since) & (F.col("ds") < ds))
    return dedup.drop_stored(rows, earlier, ["source", "job_key"])


def _observed(observation: Observation) -> dict:
    """The metrics, or nothing where AQE pruned the observed stage of an empty run."""
    try:
        return observation.get or {}
    except Py4JJavaError as exc:
        if exc.java_exception.getClass().getName() != "java.lang.AssertionError":  # Spark's own: there is no metrics row
            raise
        return {}


def run(
    spark: SparkSession,
    pages: DataFrame,
    ds: str,
    raw_path: str,
    processed_path: str,
    rules: Mapping[str, Sequence] = EXTRACTION_RULES,
    stats: dict | None = None,
    extractor: Callable = extract_pages,
    seen_days: int = 0,
    counters_path: str | None = None,
) -> DataFrame:
    """One daily run for ``ds``: extract, write raw, transform, write
    processed. Rerunning the same ``ds`` replaces only its partitions; an
    empty run leaves them alone (F10).

    The raw layer is the lineage cut: the processed layer is computed from
    the written raw rows, so the HTML is parsed once and a lost executor
    during the transform only recomputes from Parquet. ``stats`` (a dict)
    receives the S8/A11 counters in all; ``counters_path`` names a layer that
    gets them per (ds, source), counted in the same passes. Only sources with rows in this run are
    processed again. With ``seen_days`` a posting that the processed layer holds
    under the same source and key, in the so many days before ``ds``, is dropped
    (A8 across runs); days from ``ds`` on are never looked at, so a rerun of any
    day gives the same rows. Returns the processed rows of this ``ds``.
    """
    obs: dict = {}
    postings = stamp(extract_postings(pages, rules, observations=obs, extractor=extractor), ds)
    raw = conform(postings, POSTING_FIELDS + META_FIELDS).select(*RAW_SCHEMA.fieldNames())
    written = Observation("written")
    raw = raw.observe(written, F.collect_set("source").alias("sources"))  # at most one per site
    sinks.write_layer(raw, raw_path)
    raw_back = sinks.read_layer(spark, raw_path, RAW_SCHEMA, ds=ds).where(F.col("source").isin(_observed(written).get("sources") or []))
    processed = transform(raw_back).select(*PROCESSED_SCHEMA.fieldNames())
    if seen_days:
        processed = drop_seen(spark, processed, processed_path, ds, seen_days)
    proc_obs = Observation("processed")
    processed = processed.observe(proc_obs, *counted("processed_rows", F.lit(True), rules))
    sinks.write_layer(processed, processed_path)
    got = {**_observed(obs["pages"]), **_observed(obs["output"]), **_observed(proc_obs)}
    counters = {k: int(got.get(k) or 0) for k in COUNTERS}
    log.info("ds=%s %s", ds, " ".join(f"{k}={v}" for k, v in counters.items()))
    if got.get("skipped"):
        log.warning("ds=%s: %d pages of unknown hosts skipped", ds, got["skipped"])
    if stats is not None:
        stats.update(counters)
    if counters_path is not None:
        each = [(*[int(got.get(f"{k}:{s}") or 0) for k in COUNTERS], ds, s) for s in rules if got.get(f"links:{s}")]
        sinks.write_layer(spark.createDataFrame(each, COUNTERS_SCHEMA), counters_path)
    return sinks.read_layer(spark, processed_path, PROCESSED_SCHEMA, ds=ds)


def run_committed(
    spark: SparkSession,
    pages: DataFrame,
    ds: str,
    base_path: str,
    rules: Mapping[str, Sequence] = EXTRACTION_RULES,
    stats: dict | None = None,
    extractor: Callable = extract_pages,
) -> DataFrame:
    """``run`` with both layers and the counters under one commit (S3 + S4).

    The layers ``raw``, ``processed`` and ``counters`` below ``base_path`` are
    written to folders of a new version, which ``sinks.read_committed`` does not
    see; one small file then makes that version the current one of each (ds,
    source) that had pages. A job lost at any point before leaves the earlier
    rows of all layers in place; a rerun writes a version of its own. Returns the
    committed processed rows of this ``ds``.
    """
    version = sinks.new_version()
    raw, processed, counters = (sinks.version_path(base_path, layer, version) for layer in ("raw", "processed", "counters"))
    run(spark, pages, ds, raw, processed, rules, stats, extractor, counters_path=counters)
    done = sinks.read_layer(spark, counters, COUNTERS_SCHEMA).where("parsed > 0").select("source").collect()  # at most one per site
    sinks.commit(spark, base_path, version, ds, [r.source for r in done])
    return sinks.read_committed(spark, base_path, "processed", PROCESSED_SCHEMA, ds=ds)
