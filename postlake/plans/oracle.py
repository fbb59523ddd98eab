"""DuckDB SQL spellings of the column expressions, used as the independent
check of every driver query. They mirror the documented semantics (Python
``str`` rules), not the Spark code."""

from __future__ import annotations

# Python's str.isspace() set, its \\w for texts, and the references the tables hold.
WS_CHARS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
WS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
WORD_CHARS = r"\p{L}\p{N}_"
NON_CONTENT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
REFERENCES = [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def noise(e: str, keep: str = "a-záéíóúñ") -> str:
    spaced = f"regexp_replace({e}, {q(f'[^{keep}{WS_CHARS}]')}, ' ', 'g')"
    return f"regexp_replace({spaced}, {q(f'{WS}+')}, ' ', 'g')"


def punct(e: str) -> str:
    return f"regexp_replace({e}, {q(f'[^{WORD_CHARS}{WS_CHARS}]')}, '', 'g')"


def tokens(e: str) -> str:
    return f"list_filter(string_split_regex({e}, {q(f'{WS}+')}), lambda w: w <> '')"


def first_words(e: str, n: int) -> str:
    return f"array_to_string(({tokens(f'lower({e})')})[1:{n}], ' ')"


def title_case(e: str) -> str:
    runs = f"regexp_extract_all({e}, {q(r'([\p{Lu}\p{Ll}\p{Lt}ªº]+|[^\p{Lu}\p{Ll}\p{Lt}ªº]+)')})"
    first = "CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END"
    return f"array_to_string(list_transform({runs}, lambda r: {first} || lower(r[2:])), '')"


def decode(e: str) -> str:
    out = e
    for ent, ch in REFERENCES:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    return out


def content_only(e: str) -> str:
    return f"regexp_replace({e}, {q(NON_CONTENT)}, ' ', 'g')"


def fragment_text(e: str) -> str:
    marked = f"regexp_replace({e}, '<[^>]*>', chr(1), 'g')"
    joined = f"regexp_replace({decode(marked)}, {q(WS + '*(?:' + chr(1) + WS + '*)+')}, '', 'g')"
    return strip(joined)


def first_tag_text(e: str, tag: str = "h1") -> str:
    inner = f"regexp_extract({content_only(e)}, {q(f'(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>')}, 1)"
    return f"nullif({fragment_text(inner)}, '')"


def hrefs(e: str) -> str:
    found = f"regexp_extract_all({content_only(e)}, {q(r'(?is)<a\b[^>]*?\bhref\s*=\s*\"([^\"]*)\"')}, 1)"
    return f"list_transform({found}, lambda h: {decode('h')})"


def origin(e: str) -> str:
    return f"nullif(regexp_extract({e}, {q(r'^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)')}, 1), '')"


def host(e: str) -> str:
    return f"nullif(lower(regexp_extract({e}, {q(r'^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)')}, 1)), '')"


def absolute_url(h: str, base: str) -> str:
    return (
        f"CASE WHEN {h} IS NULL OR {h} = '' THEN NULL WHEN starts_with({h}, 'http') THEN {h} "
        f"ELSE regexp_replace({base}, '/+$', '') || '/' || regexp_replace({h}, '^/+', '') END"
    )


def any_contains(e: str, words) -> str:
    return "(" + " OR ".join(f"contains({e}, {q(w)})" for w in words) + ")"
