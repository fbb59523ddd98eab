"""Flat HTML reads as native regex expressions (H1, H8, H9, F2, JS1, JS2).

These stay inside whole-stage codegen and need no Python worker; nested
selectors go through the extraction job in ``postlake.operators.extract``.
Script, style and comment bodies are removed first so their text or markup
never leaks into a result.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import WS, strip

# Every named reference of the HTML standard that ends in a semicolon, from the
# standard library's table; a reference may expand to two characters.
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

NON_CONTENT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
TAG_MARK = "\x01"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cache
def _named_table() -> str:
    """The named references as one JSON object (a literal that Spark folds to a map)."""
    return json.dumps(NAMED, ensure_ascii=False)


def _numeric(ref: Column) -> Column:
    """Character of ``#123`` / ``#x7b``; the replacement character where none exists."""
    digits = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.conv(F.substring(ref, F.lit(3), F.length(ref)), 16, 10)).otherwise(F.substring(ref, F.lit(2), F.length(ref)))
    code = digits.cast("int")
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    text = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
    return F.coalesce(text, F.lit("\ufffd"))


def decode_entities(c) -> Column:
    """Character references, named and numeric, as their characters; unknown names stay.

    Text without ``&`` is returned as it is; otherwise the text is cut at the
    references once, left to right, so decoded text is never decoded again."""
    text = _c(c)
    names = F.from_json(F.lit(_named_table()), "map<string,string>")
    refs = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))
    between = F.split(text, REFERENCE)

    def char(r: Column) -> Column:
        usual = F.when(F.startswith(r, F.lit("#")), _numeric(r))
        for name in ("amp", "lt", "gt", "quot", "nbsp"):  # before the table, which is searched in order
            usual = usual.when(r == name, F.lit(NAMED[name]))
        return usual.otherwise(F.coalesce(F.try_element_at(names, r), F.concat(F.lit("&"), r, F.lit(";"))))

    chars = F.transform(refs, char)
    pieces = F.zip_with(between, chars, lambda t, ch: F.concat(F.coalesce(t, F.lit("")), F.coalesce(ch, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def content_only(html) -> Column:
    """Drop script/style bodies and comments."""
    return F.regexp_replace(_c(html), NON_CONTENT, " ")


def fragment_text(fragment, mode: str = "strip") -> Column:
    """Text of an HTML fragment.

    ``strip``: every text node stripped and joined with nothing (the
    ``get_text(strip=True)`` rule); ``raw``: tags removed, text kept as is.
    """
    marked = F.regexp_replace(_c(fragment), r"<[^>]*>", TAG_MARK)
    decoded = decode_entities(marked)
    if mode == "raw":
        return F.replace(decoded, F.lit(TAG_MARK), F.lit(""))
    joined = F.regexp_replace(decoded, f"{WS}*(?:{TAG_MARK}{WS}*)+", "")
    return strip(joined)


def first_tag_text(html, tag: str = "h1") -> Column:
    """H1: stripped text of the first ``<tag>`` element; null when missing or empty."""
    inner = F.regexp_extract(content_only(html), f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>", 1)
    return F.nullif(fragment_text(inner), F.lit(""))


A_HREF = r"""(?is)<a(?=[\s/])(?:[^>"']|"[^"]*"|'[^']*')*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def hrefs(html) -> Column:
    """H8: every ``href`` of an ``<a>`` tag — double-quoted, single-quoted or
    unquoted, never a ``data-href`` or text inside another attribute — with
    entities decoded, in document order."""
    found = F.regexp_extract_all(content_only(html), F.lit(A_HREF), 1)
    quoted = lambda h: F.substring(h, 1, 1).isin('"', "'")
    return F.transform(found, lambda h: decode_entities(F.when(quoted(h), F.substring(h, F.lit(2), F.length(h) - 2)).otherwise(h)))


def page_text(html) -> Column:
    """H9: whole-document text (tags removed, entities decoded)."""
    return fragment_text(content_only(html), mode="raw")


def is_blocked(html, phrases: Sequence[str]) -> Column:
    """empty/null page, or any phrase (case-insensitive) in the page."""
    low = F.lower(_c(html))
    hit = F.lit(False)
    for p in phrases:
        hit = hit | F.contains(low, F.lit(p.lower()))
    return _c(html).isNull() | (_c(html) == "") | hit


def jsonld_block(html) -> Column:
    """JS1: body of the first ``<script type="application/ld+json">``."""
    body = F.regexp_extract(
        _c(html),
        r"(?is)<script\b[^>]*\btype\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script\s*>",
        1,
    )
    return F.nullif(body, F.lit(""))


# --- fixed values: JobPosting paths read from the JSON-LD block ---
JSONLD_PATHS: dict[str, str] = {
    "title": "$.title",
    "company": "$.hiringOrganization.name",
    "location": "$.jobLocation.address.addressLocality",
    "employment_type": "$.employmentType",
    "date_posted": "$.datePosted",
    "description": "$.description",
}


def jsonld_value(js) -> Column:
    """JS2, step 1: parse the block once into a variant; malformed → null."""
    return F.try_parse_json(_c(js))


def jsonld_holds_fields(v) -> Column:
    """the block parsed to something that is not empty (``{}``, ``[]``, ``""``, 0, false and null are)."""
    return F.coalesce(~F.to_json(_c(v)).isin("{}", "[]", '""', "0", "false", "null"), F.lit(False))


def jsonld_get(v, field: str) -> Column:
    """JS2, step 2: one JobPosting field as text (null when absent or when the
    path hits a list or a scalar on the way)."""
    return F.try_variant_get(_c(v), JSONLD_PATHS[field], "string")
