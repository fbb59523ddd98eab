"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def host(url) -> Column:
    """Host part of an absolute URL (lower-cased), null when absent."""
    return F.nullif(F.lower(F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)", 1)), F.lit(""))


def origin(url) -> Column:
    """``scheme://host[:port]`` of an absolute URL."""
    return F.nullif(F.regexp_extract(_c(url), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1), F.lit(""))


def absolute_url(href, base) -> Column:
    """Empty → null; ``http…`` kept; else ``base`` and ``href`` joined
    with exactly one ``/``."""
    h, b = _c(href), (F.lit(base) if isinstance(base, str) and "://" in base else _c(base))
    joined = F.concat(F.regexp_replace(b, "/+$", ""), F.lit("/"), F.regexp_replace(h, "^/+", ""))
    return F.when(h.isNull() | (h == ""), F.lit(None).cast("string")).when(h.startswith("http"), h).otherwise(joined)


def canonical_by_param(url, base, param: str = "jk", path: str = "/viewjob") -> Column:
    """Rebuild ``base + path?param=<id>`` from the first ``param=<id>``
    in the URL; URLs without it stay unchanged."""
    u = _c(url)
    b = F.lit(base) if isinstance(base, str) and "://" in base else _c(base)
    ident = F.regexp_extract(u, f"{param}=([a-zA-Z0-9]+)", 1)
    return F.when(ident != "", F.concat(b, F.lit(f"{path}?{param}="), ident)).otherwise(u)


def site_key(c) -> Column:
    """Lower-case, spaces to underscores."""
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_"))
