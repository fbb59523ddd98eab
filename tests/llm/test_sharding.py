"""Operator 8: the properties that make a valid schedule."""

import random
import zlib
from collections import defaultdict

import pytest
from postlake.llm import sharding


def run(docs, shards=6):
    return [r.asDict() for r in sharding.shard_documents(docs, shards).collect()]


def test_balance_groups_and_slots(spark, docs_of):
    rng = random.Random(1)
    texts = ["é" * rng.randint(0, 400) + str(rng.randint(0, 250)) for _ in range(500)] + ["copy of a text"] * 60 + [None, "", None]
    ids = [None if i % 50 == 0 else i for i in range(len(texts))]
    got = run(docs_of(texts, ids, shard=["x"] * len(texts), group=["y"] * len(texts)))
    assert len(got) == len(texts)
    expected = sorted((i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == expected
    load, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[r["size"], r["text_crc32"]].add(r["shard"])
    assert max(load.values()) <= 1.02 * min(load.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_a_giant_group_fills_a_shard(spark, docs_of):
    texts = ["giant " * 100] * 50 + [f"small {i}" for i in range(300)]
    got = run(docs_of(texts), 4)
    giant = {r["shard"] for r in got if r["size"] > 500}
    assert len(giant) == 1 and all(r["size"] > 500 for r in got if r["shard"] in giant)
    rest = defaultdict(int)
    for r in got:
        rest[r["shard"]] += r["size"]
    others = [v for s, v in rest.items() if s not in giant]
    assert max(others) - min(others) <= 20


def test_many_partitions_and_few_bins(spark, docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "PACKAGES", 80)
    rng = random.Random(8)
    texts = ["x" * int(rng.paretovariate(1.2) * 20) + str(i) for i in range(2000)]
    load = defaultdict(int)
    for r in run(docs_of(texts), 5):
        load[r["shard"]] += r["size"]
    even = sum(load.values()) / 5
    assert max(load.values()) <= max(1.05 * even, max(map(len, texts)) + 8)


def test_schedule_is_longest_first():
    assert sharding.schedule([(1, 5), (2, 4), (3, 3), (4, 3), (5, 3)], 2) == [(1, 0), (2, 1), (3, 1), (4, 0), (5, 1)]


@pytest.mark.parametrize("texts", [[], ["one"]])
def test_few_rows(spark, docs_of, texts):
    assert len(run(docs_of(texts))) == len(texts)
