"""Operator 11 against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from postlake.llm import spelling


def brute_words(rows, every=199, length=6, least=5):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts, times=5):
    near_of = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in near_of.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near_of[w]), counts[form[w]] if form[w] else None))
    return out


def texts_with_errors(seed, n=120):
    rng = random.Random(seed)
    letters = "abeéÀßnrst"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(60)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 80)):
            w = base[min(int(rng.expovariate(0.15)), 59)]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k, c = rng.randrange(len(w)), rng.choice(letters)
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
            words.append(w.upper() if rng.random() < 0.05 and w.isascii() else w)
        texts.append(rng.choice([" ", "-", "\n", "7"]).join(words))
    return texts


def rows_of(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, docs_of, monkeypatch, small):
    if small:  # many cells, cells in parts, and a sample that has not seen all words
        for name, value in {"CELL": 16, "GROUP": 8, "LEAST": 2, "SAMPLE": 60, "QUERIES": 7, "PAIRS": 50, "LEAF": 2}.items():
            monkeypatch.setattr(spelling, name, value)
    texts = texts_with_errors(3) + [None, "", "123 ---", "ab cd", "x" * 3000, ("y" * 300 + " ") * 6]
    ids = list(range(len(texts) - 1)) + [None]
    docs = docs_of(texts, ids, word=["w"] * len(texts), n=["n"] * len(texts))
    got = rows_of(spelling.spelling_variants(docs, every=7, least_count=2, times=2))
    want = brute(brute_words(zip(ids, texts, strict=True), every=7, least=2), times=2)
    assert got == want
    assert any(f for _, f, *_ in want) and any(r != f for w, f, r, *_ in want if f)


def test_chains_end_at_the_root(spark):
    names = ["abcdef" + "x" * k for k in range(12)]
    words = spark.createDataFrame([(w, 5 * 6**k) for k, w in enumerate(names)], "word string, n long")
    got = {r.word: (r.form, r.root) for r in spelling.variants(words).collect()}
    assert got == {w: (names[k + 1] if k < 11 else None, names[-1]) for k, w in enumerate(names)}


def test_repeated_rows_and_empty_tables(spark, docs_of):
    same = docs_of(["planets planets"] * 3, [4, 4, 5])
    assert rows_of(spelling.spelling_variants(same, least_count=6)) == {("planets", None, "planets", 6, 0, None)}
    assert spelling.spelling_variants(docs_of([])).count() == 0
    assert spelling.spelling_variants(docs_of([None, ""])).count() == 0


def test_trees_lose_nothing():
    rng = np.random.default_rng(2)
    words = sorted({bytes(rng.choice(list(b"abc\xe9"), 7).astype(np.uint8)) for _ in range(700)})
    group = spelling.WordGroup(words)
    q, p = group.near(words)
    pairs = {(a, b) for a in range(len(words)) for b in range(len(words)) if near(words[a].decode("latin-1"), words[b].decode("latin-1"))}
    assert set(zip(q.tolist(), p.tolist(), strict=True)) == pairs and len(q) == len(pairs)
    coarse = spelling.Tree(spelling.letter_counts(words[:50]), 4, tight=False)
    x = spelling.letter_counts(words)
    reached = {(r, n) for row, node in coarse.near_leaves(x, 2) for r, n in zip(row.tolist(), coarse.leaf_number[node].tolist(), strict=True)}
    home = coarse.home(x)
    assert all((a, home[b]) in reached for a, b in pairs)
