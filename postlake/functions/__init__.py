"""Column expressions. Every function takes and returns ``Column`` objects and
compiles to built-in Spark expressions (no Python UDFs)."""

from postlake.functions.text import (  # noqa: F401
    WS,
    first_int,
    first_date,
    first_nonempty,
    first_words,
    lower,
    remove_noise,
    remove_punct,
    safe_name,
    slug,
    split_last,
    strip,
    title_case,
    today_ds,
    tokens,
)
from postlake.functions.keys import job_key  # noqa: F401
from postlake.functions.urls import absolute_url, canonical_by_param, host, origin, site_key  # noqa: F401
from postlake.functions.classify import (  # noqa: F401
    any_contains,
    classify_contains,
    first_matching,
    flag_phrase,
    normalize_region,
)
from postlake.functions.arrays import clean_list, join_lines, range_string, set_union  # noqa: F401
