"""Operator 13 against a brute-force version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from postlake.llm import lexical


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = set()
    for item, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out |= {(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, item_id long").repartition(3)
    b = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id long")
    rows = lexical.rank_documents(d, b, k).collect()
    out = {tuple(r) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["The", "of", "Ünï", "cafÉ", "x²", "naïve"] + [f"W{k}" for k in range(150)]
    docs = [(i, rng.choice([" ", ", ", "\n", "__"]).join(rng.choices(words, [300 // (k + 1) + 1 for k in range(len(words))], k=rng.randint(0, 90)))) for i in range(200)]
    docs += [(300 + j, docs[5][1]) for j in range(30)] + [(400, None), (401, ""), (402, "--- \t"), (None, docs[7][1]), (9, docs[9][1]), (9, docs[9][1])]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(25)]
    items += [(30, docs[5][1]), (31, None), (32, ""), (33, "unheard words"), (30, docs[5][1]), (34, "The the THE"), (None, "w1 w2")]
    return docs, items


@pytest.mark.parametrize("tiles", [None, (7, 5, 3, 4)])
def test_equals_brute_force(spark, monkeypatch, tiles):
    if tiles:
        for name, value in zip(("DOCS", "VOCABULARY", "ITEMS", "BLOCK_ITEMS"), tiles, strict=True):
            monkeypatch.setattr(lexical, name, value)
    docs, items = corpus(5)
    assert found(spark, docs, items) == brute(docs, items)


def test_sums_beyond_exact_doubles_are_split(spark, monkeypatch):
    docs, items = corpus(6)
    monkeypatch.setattr(lexical, "EXACT", 20_000 * lexical.IMPACT)
    assert found(spark, docs, items, 3) == brute(docs, items, 3)


def test_tiles_bound_partial_sums():
    term, item = np.repeat(np.arange(50), 2), np.tile(np.arange(2), 50)
    gain = np.full(100, 10**9)
    for a, b in lexical.vocabulary_tiles(term, item, gain, 50):
        assert (b - a) * 10**9 * lexical.IMPACT < lexical.EXACT
    assert lexical.vocabulary_tiles(term, item, gain * 10, 50) == [(t, t + 1) for t in range(50)]
    assert lexical.vocabulary_tiles(term[:0], item[:0], gain[:0], 0) == []


def test_one_id_with_two_texts_and_empty_tables(spark):
    docs = [(1, "a b"), (2, "b c")]
    assert found(spark, docs, [(1, "a"), (1, "c")]) == brute(docs, [(1, "a"), (1, "c")])
    assert found(spark, [], [(1, "a")]) == set() and found(spark, docs, []) == set() and found(spark, [(1, None)], [(1, "a")]) == set()


def test_long_texts(spark):
    docs = [(1, "word " * 200_000 + "rare"), (2, "rare word"), (3, "other")]
    assert found(spark, docs, [(1, "rare word " * 50)]) == brute(docs, [(1, "rare word " * 50)])
