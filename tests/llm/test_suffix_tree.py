"""Operator 10 against counts and probabilities built symbol by symbol."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from postlake.llm import suffix_tree as st


def trained(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 1


def corpus():
    rng = random.Random(6)
    words = ["The", "cat", "sat", "on", "a", "mat", "élan", "Ünder", "x-1", "rare"]
    texts = [" ".join(rng.choice(words[: 2 + k % 9]) for _ in range(rng.randint(0, 40))) + ("\n" if k % 3 else "") for k in range(80)]
    return texts + [None, "", " \t", "only here", "The\x0bcat\x1c sat", "long words " * 400]


def tree_by_hand(rows):
    """Contexts, smoothing and longest-suffix scores as the module's text states them."""
    grams = Counter()
    for i, t in rows:
        if trained(i):
            s = b"\n" * st.DEPTH + b" ".join((t or "").encode().lower().split()) + b"\n"
            grams.update(s[k : k + st.DEPTH + 1] for k in range(len(s) - st.DEPTH))
    nexts = [{} for _ in range(st.DEPTH + 1)]
    for g, n in grams.items():
        for d in range(st.DEPTH + 1):
            c = nexts[d].setdefault(g[st.DEPTH - d : st.DEPTH], Counter())
            c[g[-1]] += n
    least = math.ceil(st.MIN_SHARE * grams.total())
    kept = {b"": nexts[0].get(b"", Counter())}
    for d in range(1, st.DEPTH + 1):
        for c, n in nexts[d].items():
            up = nexts[d - 1][c[1:]]
            kl = sum(v / n.total() * math.log(v / n.total() / (up[x] / up.total())) for x, v in n.items())
            if n.total() >= least and kl >= st.DIVERGENCE:
                kept[c] = n

    def chance(c, x):
        n = kept[c]
        if not c:
            return (n[x] + st.ROOT) / (n.total() + 256 * st.ROOT)
        up = c[1:]
        while up not in kept:
            up = up[1:]
        return (n[x] + st.BACK_OFF * chance(up, x)) / (n.total() + st.BACK_OFF)

    def score(text):
        s = b"\n" * st.DEPTH + b" ".join((text or "").encode().lower().split()) + b"\n"
        total = 0.0
        for k in range(st.DEPTH, len(s)):
            c = s[k - st.DEPTH : k]
            while c not in kept:
                c = c[1:]
            total += math.log10(chance(c, s[k]))
        return total

    return kept, chance, score


@pytest.mark.parametrize("hot", [0, 3, st.HOT_TOKENS])
def test_equals_brute_force(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(st, "STRETCH", 16)
    monkeypatch.setattr(st, "MIN_SHARE", 2e-3)
    texts = corpus()
    ids = [None if k == 7 else k for k in range(len(texts))]
    rows = list(zip(ids, texts, strict=True))
    words = {k: [*(t or "").encode().lower().split(), b"\n"] for k, (_, t) in enumerate(rows)}
    counts = Counter(w for k, (i, _) in enumerate(rows) if trained(i) for w in words[k])
    n, v = counts.total(), len(counts)
    kept, _, score = tree_by_hand(rows)
    assert len(kept) > 20
    got = {r.doc_id: r for r in st.score_documents(docs_of(texts, ids, score=["x"] * len(texts), token=["y"] * len(texts)), 5, hot).collect()}
    assert len(got) == len(texts)
    for k, (i, t) in enumerate(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not trained(i), len(words[k]), sum(counts[w] > 0 for w in words[k]), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words[k]), rel=1e-9)
        assert r.score == pytest.approx(score(t), rel=1e-5)


def test_distributions_sum_to_one(spark, docs_of):
    rows = list(enumerate(corpus()))
    _, chance, _ = tree_by_hand(rows)
    assert sum(chance(b"", x) for x in range(256)) == pytest.approx(1)
    assert sum(chance(b"e", x) for x in range(256)) == pytest.approx(1)


def test_no_rows_and_no_training(spark, docs_of):
    assert st.score_documents(docs_of([])).count() == 0
    got = st.score_documents(docs_of(["ab", None], [None, None])).collect()
    assert sorted(round(r.score, 6) for r in got) == [round(3 * math.log10(1 / 256), 6), round(math.log10(1 / 256), 6)]
    assert {r.train_tokens for r in got} == {0}


def test_stretches_do_not_matter(spark):
    import pyarrow as pa

    table = pa.table({"depth": [0, 0, 1], "context": [0, 0, 97], "next": [97, 98, 98], "n": [5, 3, 2]})
    tree = st.SuffixTree(table)
    texts = [b"ab" * 2000 + b"\n", b"\n", b"abba\n"]
    whole = tree.score(texts)
    old, st.STRETCH = st.STRETCH, 7
    try:
        assert np.allclose(tree.score(texts), whole)
    finally:
        st.STRETCH = old


def test_least_count_does_not_rise_with_the_corpus(spark, docs_of):
    # contexts seen a few times are still told apart when a million other symbols were read
    texts = ["zq" * 5 + " qz xk"] * 8 + ["the cat sat on the mat " * 4000] * 12
    ids = [i for i in range(200) if trained(i)][: len(texts)]
    got = {r.doc_id: r for r in st.score_documents(docs_of(texts, ids)).collect()}
    _, _, score = tree_by_hand(list(zip(ids, texts, strict=True)))
    assert got[ids[0]].score == pytest.approx(score(texts[0]), rel=1e-5)
    assert got[ids[0]].score > -8


@pytest.mark.parametrize("runs", [0, 300])
def test_runs_outside_the_broadcast_give_the_same(spark, docs_of, monkeypatch, runs):
    monkeypatch.setattr(st, "TOGETHER", 1)
    docs = docs_of(corpus())
    whole = {r.doc_id: r.score for r in st.score_documents(docs).collect()}
    got = {r.doc_id: r.score for r in st.score_documents(docs, hot_runs=runs).collect()}
    assert got == pytest.approx(whole, rel=1e-9)
