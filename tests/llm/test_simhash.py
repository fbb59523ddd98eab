"""Operator 5 against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash
from postlake.llm import simhash
from postlake.llm.components import components


def brute_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=4):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    low = {}
    for k, i in zip(label, ids, strict=True):
        if i is not None:
            low[k] = min(low.get(k, i), i)
    return [low.get(k) for k in label]


def corpus():
    rng = random.Random(5)
    words = [f"w{k}É" if k % 7 == 0 else f"W{k}" for k in range(400)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append("\t".join(near))
    return texts + [None, "", " \n\x0b", "one", "one", "ONE", "a b c", "long " * 30_000]


@pytest.mark.parametrize("blocks", [5, 7])
def test_fingerprints_and_components(spark, docs_of, blocks):
    texts = corpus()
    ids = [1000 - i if i % 9 else None for i in range(len(texts))]
    fps = [brute_fingerprint(t) for t in texts]
    got = simhash.near_duplicates(docs_of(texts, ids, fp=["x"] * len(texts), shard=["y"] * len(texts)), 4, 4, blocks).collect()
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((i or -1, f"{f:016x}") for i, f in zip(ids, fps, strict=True))
    expected = sorted((i or -1, c or -1) for i, c in zip(ids, brute_components(ids, fps), strict=True))
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == expected


def test_hot_shards_are_split_into_trees(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TREE", 16)
    rng = random.Random(2)
    fps = sorted({0x1234_5678_9ABC << 8 ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(300)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, 5)
    root = {r.node: r.root for r in components(links).collect()}
    label = brute_components(list(range(len(fps))), fps)
    groups = {}
    for f, k in zip(signed, label, strict=True):
        groups.setdefault(k, set()).add(root.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_forest_follows_only_matching_edges():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(-(2**62), 2**62, 500) & 0xFFFF)
    forest = simhash.Forest(values, np.zeros(len(values), int))
    got = {(int(p), int(v)) for ps, vs in forest.visit(values, np.zeros(len(values), int), 2) for p, v in zip(ps, vs, strict=True)}
    near = simhash.bits_apart(np.repeat(values, len(values)), np.tile(values, len(values))).reshape(len(values), -1) <= 2
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)}


def test_no_rows(spark, docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.keep_one(docs_of([])).count() == 0


def test_keep_one_keeps_one_of_each_group(spark, docs_of):
    text = " ".join(f"w{k}" for k in range(200))
    docs = docs_of([text, text, text, "other words here now", None, "", None], [5, 3, 3, 9, 7, None, None], component_id=["x"] * 7)
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [3, 7, 9]
    lone = docs_of(["same old text", "same old text", "quite another one"], [None, None, 4])
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(lone).collect()) == [(0, "same old text"), (4, "quite another one")]


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 201: 200}


def test_keep_one_goes_by_row_not_by_id(spark, docs_of):
    texts = [" ".join(f"{w}{k}" for k in range(60)) for w in ("a", "b", "c")]
    docs = docs_of([*texts, texts[1], texts[2], texts[2]], [1, 1, 2, 5, 2, 2], source=["x", "y", "z", "w", "k", None])
    got = sorted((r.doc_id, r.text[:2], r.source or "") for r in simhash.keep_one(docs).collect())
    assert got[:2] == [(1, "a0", "x"), (1, "b0", "y")] and len(got) == 3 and got[2][:2] == (2, "c0")
    assert got == sorted((r.doc_id, r.text[:2], r.source or "") for r in simhash.keep_one(docs.repartition(5)).collect())
    assert simhash.keep_one(docs.select("doc_id", "text")).count() == 3


def test_shingles_of_a_batch_are_held_in_part():
    import tracemalloc

    import pyarrow as pa

    from postlake.llm import simhash

    batch = pa.record_batch({"doc_id": list(range(40)), "text": ["ab " * 16_000] * 40})
    run = simhash._fingerprinter(4)
    list(run(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    got = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == 40 and peak < 60 << 20
