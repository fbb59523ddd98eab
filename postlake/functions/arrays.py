"""List expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import strip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_list(arr, drop_values: Sequence[str] = ()) -> Column:
    """F9 + F11: strip every item, drop blank items and items whose lower-case
    form is in ``drop_values``."""
    stripped = F.transform(_c(arr), lambda x: strip(x))
    drops = [d.lower() for d in drop_values]

    def keep(x):
        cond = x.isNotNull() & (x != "")
        if drops:
            cond = cond & ~F.lower(x).isin(drops)
        return cond

    return F.filter(stripped, keep)


def set_union(*arrs) -> Column:
    """U2 + A10: union of lists as a sorted distinct list (deterministic order)."""
    cols = [F.coalesce(_c(a), F.array().cast("array<string>")) for a in arrs]
    merged = cols[0]
    for a in cols[1:]:
        merged = F.array_union(merged, a)
    return F.array_sort(F.array_distinct(merged))


def join_lines(arr, sep: str = "\n") -> Column:
    """Items joined by newlines; null for an empty or null list."""
    return F.when(F.size(_c(arr)) > 0, F.array_join(_c(arr), sep))


def range_string(a, b, sep: str = " - ") -> Column:
    """``a<sep>b`` only when both parts are present."""
    ca, cb = _c(a), _c(b)
    return F.when(ca.isNotNull() & cb.isNotNull(), F.concat(ca.cast("string"), F.lit(sep), cb.cast("string")))
