"""Operator 9 against brute force."""

import math

import numpy as np
import pytest
from postlake.llm import topk


def brute(rows, every, k, scale=1024.0):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    asked = {}
    for i, v in good:
        if i % every == 0 and (i not in asked or v < asked[i]):
            asked[i] = v
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, every, k):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    return sorted(tuple(r) for r in topk.top_k(df, "vec_id", "embedding", every, k).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("kind", ["unit", "skewed", "ties"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "BLOCK", 37)
    monkeypatch.setattr(topk, "QUERIES", 5)
    monkeypatch.setattr(topk, "STEP", 8)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 12)) * np.geomspace(1, 0.05, 12)
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1)[:, None]
    elif kind == "skewed":
        x *= rng.pareto(1.0, 400)[:, None]
    else:
        x = rng.integers(-1, 2, size=(400, 12)) / 8
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert run(spark, rows, 20, 10) == brute(rows, 20, 10)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [math.nan, 1.0]), (4, [math.inf, 0.0]), (None, [1.0, 1.0]), (5, [-1.0, 0.5]), (5, [-1.0, 0.5]), (6, [0.0, 0.0]), (7, []), (8, [3.0]), (20, [1e-9, -1e-9]), (0, [1.0, 2.0])]
    assert run(spark, rows, 20, 10) == brute(rows, 20, 10)


def test_large_components_and_few_rows(spark):
    rows = [(0, [1e9, 1.0]), (1, [1e9, 2.0]), (2, [-1e9, 3.0]), (3, [5e8, -7.0])]
    expected = [(q, n, i, min(max(s, -(2**63)), 2**63 - 1)) for q, n, i, s in brute(rows, 20, 10)]
    got = run(spark, rows, 20, 10)
    assert [(q, i) for q, _, i, _ in got] and sorted(s for *_, s in got) == sorted(s for *_, s in expected)
    assert run(spark, [], 20, 10) == [] and run(spark, [(20, [1.0])], 20, 10) == []


def test_no_cartesian_product_without_broadcasts(spark, capsys):
    """Query blocks meet vector blocks by number, also when nothing may be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
        topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 20, 3).explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
