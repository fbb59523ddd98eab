"""Rule-driven classifiers (X10-X13, K3, J2 as a row-local ``when`` chain)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import remove_noise


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any_contains(col: Column, words: Sequence[str]) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | F.contains(col, F.lit(w))
    return cond


def classify_contains(
    c,
    rules: Sequence[tuple[str, Sequence[str]]],
    default: str | None = "Otros",
    lower_case: bool = True,
) -> Column:
    """First rule whose keyword occurs in the (lower-cased) text; null or
    no hit gives ``default``. Rules are ``(label, [keywords])`` in priority order."""
    text = F.lower(_c(c)) if lower_case else _c(c)
    expr = None
    for label, words in rules:
        cond = _any_contains(text, words)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return F.when(_c(c).isNull(), F.lit(default)).otherwise(expr.otherwise(F.lit(default)))


def normalize_region(
    c,
    rules: Sequence[tuple[str, Sequence[str]]],
    remote_words: Sequence[str] = (),
    remote_label: str = "remote",
    keep_class: str = "a-záéíóúñ",
    unmatched: str = "keep",
) -> Column:
    """X11: null → null; lower-case; noise removal (X3); any remote word →
    ``remote_label``; first category whose keyword is a substring (rule order
    is priority); otherwise the cleaned text (``unmatched="keep"``) or null.

    The rule table is small and fixed, so this is one ``CASE WHEN`` chain —
    row-local, no join, no shuffle. The cleaned text is computed once and the
    chain reads it as a lambda variable, so the chain never inlines the two
    regex replacements per branch (which would overflow the 64 KB generated
    method limit once the expression is fused into an aggregate).
    """
    raw = _c(c)
    cleaned = remove_noise(F.lower(raw), keep_class)

    def chain(t: Column) -> Column:
        expr = None
        if remote_words:
            expr = F.when(_any_contains(t, remote_words), F.lit(remote_label))
        for label, words in rules:
            cond = _any_contains(t, words)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        fallback = t if unmatched == "keep" else F.lit(None).cast("string")
        return fallback if expr is None else expr.otherwise(fallback)

    return F.when(raw.isNotNull(), F.try_element_at(F.transform(F.array(cleaned), chain), F.lit(1)))


def any_contains(arr, words: Sequence[str]) -> Column:
    """Some element contains (case-insensitively) one of ``words``."""
    return F.exists(_c(arr), lambda x: _any_contains(F.lower(x), [w.lower() for w in words]))


def first_matching(arr, words: Sequence[str]) -> Column:
    """K3: first element containing one of ``words`` (case-insensitive), else null."""
    hits = F.filter(_c(arr), lambda x: _any_contains(F.lower(x), [w.lower() for w in words]))
    return F.try_element_at(hits, F.lit(1))


def flag_phrase(c, phrase: str, label: str) -> Column:
    """``label`` when the text contains ``phrase`` in any case, else null."""
    return F.when(F.contains(F.lower(_c(c)), F.lit(phrase.lower())), F.lit(label))
