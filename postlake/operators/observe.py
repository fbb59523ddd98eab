"""Row counts at several points of one plan, gathered by Observations
during a single action (no extra count jobs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def count_stages(df: DataFrame, stages: Sequence[tuple[str, Column | None]]) -> list[tuple[str, int]]:
    """Apply the stage filters in order, observe the row count after each and
    run the plan once with a no-op sink. Returns ``[(stage, rows), ...]``."""
    observations = []
    cur = df
    for name, cond in stages:
        if cond is not None:
            cur = cur.where(cond)
        obs = Observation(name)
        cur = cur.observe(obs, F.count(F.lit(1)).alias("rows"))
        observations.append((name, obs))
    cur.write.format("noop").mode("overwrite").save()
    return [(name, int(obs.get["rows"])) for name, obs in observations]
