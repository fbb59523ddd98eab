"""The posting business key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def job_key(url, title, company, sep: str = "", null_token: str = "", width: int = 20) -> Column:
    """First ``width`` hex digits of SHA-256 over ``url‖title‖company``.

    The parts are concatenated without a separator by default; a null part
    contributes ``null_token`` (G1).
    """
    parts = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit(null_token)) for p in (url, title, company)]
    return F.substring(F.sha2(F.concat_ws(sep, *parts), 256), 1, width)
