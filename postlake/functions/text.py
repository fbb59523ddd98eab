"""Text expressions with Python ``str`` semantics.

Regexes stay inside the subset shared by Java regex and RE2 so the same
pattern can be checked against DuckDB: no lookaround, no ``(?U)``, and
character classes spelled out instead of ``\\w`` / ``\\s``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set: ASCII controls, NEL and every Unicode separator.
WS_CHARS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
WS = f"[{WS_CHARS}]"
# Python's \w for str patterns: letters, digits and underscore.
WORD_CHARS = r"\p{L}\p{N}_"
# Characters with case, as ``str.title`` sees them.
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c) -> Column:
    """X1."""
    return F.lower(_c(c))


def strip(c) -> Column:
    """``str.strip()`` — removes Unicode whitespace at both ends."""
    return F.regexp_replace(_c(c), f"^{WS}+|{WS}+$", "")


def title_case(c) -> Column:
    """``str.title()`` — upper-case the first cased character of every run
    of cased characters, lower-case the rest; anything without case (a digit,
    a mark, an ideograph) starts a new word.

    ``initcap`` only starts words after a space, so a space is inserted after
    every other uncased character, ``initcap`` runs, and exactly those inserted
    spaces are removed again (each such character is followed by its own
    inserted space, so the left-to-right pairing is exact)."""
    spaced = F.regexp_replace(_c(c), f"([^{CASED} ])", "$1 ")
    return F.regexp_replace(F.initcap(spaced), f"([^{CASED} ]) ", "$1")


def remove_noise(c, keep_class: str = "a-záéíóúñ") -> Column:
    """Characters outside ``keep_class`` and whitespace become a space, then
    whitespace runs collapse to one space (no trim)."""
    spaced = F.regexp_replace(_c(c), f"[^{keep_class}{WS_CHARS}]", " ")
    return F.regexp_replace(spaced, f"{WS}+", " ")


def remove_punct(c) -> Column:
    """Drop everything that is neither a word character nor whitespace."""
    return F.regexp_replace(_c(c), f"[^{WORD_CHARS}{WS_CHARS}]", "")


def tokens(c) -> Column:
    """``str.split()`` — whitespace split without empty items."""
    return F.filter(F.split(_c(c), f"{WS}+"), lambda w: w != "")


def first_words(c, n: int = 5) -> Column:
    """The first ``n`` lower-cased words joined by one space; null-safe.

    Equal to ``" ".join(text.lower().split()[:n])`` on the whole text: one
    regex match finds the first ``n`` whitespace-separated words (words after
    the ``n``-th cannot change the result), then whitespace runs collapse to
    one space. No array of all words is built."""
    col = _c(c)
    if n <= 0:
        return F.when(col.isNotNull(), F.lit(""))
    word = f"[^{WS_CHARS}]+"
    head = F.regexp_extract(col, f"^{WS}*({word}(?:{WS}+{word}){{0,{n - 1}}})", 1)
    return F.when(col.isNotNull(), F.lower(F.regexp_replace(head, f"{WS}+", " ")))


def first_int(c) -> Column:
    """First run of ASCII digits as an int; null when there is none or it
    does not fit."""
    digits = F.regexp_extract(_c(c), r"([0-9]+)", 1)
    return F.when(digits != "", digits).try_cast("int")


def first_date(c) -> Column:
    """First ``d/m/yyyy`` token, kept as text."""
    return F.nullif(F.regexp_extract(_c(c), r"\b([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})\b", 1), F.lit(""))


def split_last(c, sep: str = " - ") -> tuple[Column, Column]:
    """``(head, last)`` of a split on a literal separator, found from the
    left without overlaps, as ``str.split`` finds it.

    With the separator present, ``head`` is every part but the last, joined by
    the separator, and ``last`` the last part, both stripped; otherwise
    ``head`` is the whole stripped text and ``last`` is null.
    """
    parts = F.split(_c(c), "\\Q" + sep + "\\E")
    many = F.size(parts) > 1
    head = F.when(many, strip(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), sep))).otherwise(strip(c))
    return head, F.when(many, strip(F.element_at(parts, -1)))


def slug(c, sep: str = "-", lower_case: bool = True) -> Column:
    """Spaces to ``sep`` (optionally lower-cased first)."""
    col = F.lower(_c(c)) if lower_case else _c(c)
    return F.replace(col, F.lit(" "), F.lit(sep))


def safe_name(c, max_len: int = 200) -> Column:
    """Characters outside ``[a-zA-Z0-9_-]`` become ``_``, cut at ``max_len``."""
    return F.substring(F.regexp_replace(_c(c), r"[^a-zA-Z0-9_\-]", "_"), 1, max_len)


def first_nonempty(*cols) -> Column:
    """Python ``a or b or c`` for strings — empty strings fall through;
    the last operand is returned as is."""
    cs = [_c(c) for c in cols]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs[:-1]], cs[-1])


def today_ds() -> Column:
    """The default run date, ``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")
