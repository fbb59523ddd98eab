"""Operators 6 and 1: held-out accuracy and edge cases."""

import os
import zlib

import numpy as np
import pytest
from postlake.llm import language_id, toxicity
from postlake.llm.common import held_out
from postlake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")


def fold(i, m=3):
    return zlib.crc32(str(i).encode()) % m == 1


@data
def test_language_held_out_accuracy(spark):
    got = QUERIES["op6_language_id"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == fold(r.doc_id) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def brute_log_likelihood(train, text):
    """Multinomial naive Bayes with the same hashed n-grams, gram by gram."""
    def grams(t):
        low = t.lower()
        pad = low + "  "
        for n in language_id.ORDERS:
            for k in range(len(low)):
                if k + n <= len(pad):
                    codes = np.frombuffer(pad[k : k + n].encode("utf-32-le"), np.uint32)
                    yield int(language_id._buckets(codes, n)[0])
    totals = {}
    for t, lang in train:
        c = totals.setdefault(lang, np.zeros(language_id.BUCKETS))
        for g in grams(t):
            c[g] += 1
    share = {k: sum(1 for _, x in train if x == k) / len(train) for k in totals}
    return {k: np.log(share[k]) + sum(np.log((c[g] + 0.5) / (c.sum() + 0.5 * language_id.BUCKETS)) for g in grams(text)) for k, c in totals.items()}


def test_language_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language_id, "PIECE", 7)  # texts in overlapping pieces
    train = [("the cat and the hat", "en"), ("le chat et la souris", "fr"), ("der hund und die katze", "de"), ("the end", "en")]
    model = language_id.train(spark.createDataFrame([(t, x) for t, x in train] + [(None, "en"), ("x", None)], "text string, lang string"))
    for text in ("the mouse", "la souris et", "katze", "É"):
        langs, scores = model.predict([text])
        told = brute_log_likelihood(train, text)
        best = max(sorted(told), key=told.get)
        assert langs == [best]
        assert scores[0] == pytest.approx(1 / sum(np.exp(v - told[best]) for v in told.values()), rel=1e-4)


def test_language_edges(spark, docs_of):
    docs = docs_of(["the cat", None, "", "12 !? ½", "the " * 60_000], [1, None, 3, 4, 5], lang=["en", "en", None, "en", "en"], lang_pred=["x"] * 5)
    model = language_id.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    assert got == {1: ("en", 1.0), None: ("und", 0.0), 3: ("und", 0.0), 4: ("und", 0.0), 5: ("en", 1.0)}
    kept = language_id.keep_identified(docs, model, 0.5)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5]
    none = language_id.train(docs.filter("false"))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.identify(docs.filter("false"), model).count() == 0


def test_null_id_is_held_out(spark, docs_of):
    got = docs_of(["a", "b", "c"], [None, 0, 1]).select("doc_id", held_out("doc_id", 3).alias("h")).collect()
    assert {r.doc_id: r.h for r in got} == {None: True, 0: fold(0), 1: fold(1)}


def toxic_corpus(n=300):
    rng = np.random.default_rng(3)
    vocab = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    texts, labels = [], []
    for k in range(n):
        sentences = [" ".join(rng.choice(vocab, 8)) for _ in range(rng.integers(2, 12))]
        if k % 3 == 0:
            at = rng.integers(len(sentences))
            sentences[at] += " you rotten " + str(rng.choice(["dolt", "oaf"]))
        texts.append(". ".join(sentences).capitalize() + ".")
        labels.append(int(k % 3 == 0))
    return texts, labels


def test_toxicity_learns_and_locates(spark, docs_of):
    texts, labels = toxic_corpus()
    docs = docs_of(texts, score=["x"] * len(texts), toxic=["y"] * len(texts))
    marks = [(i, y) for i, y in enumerate(labels)] + [(0, 0), (None, 1), (1, None), (2, 7)]
    seen = [m for m in marks if m[0] is None or not fold(m[0])]
    model = toxicity.train(docs.filter(~held_out("doc_id", 3)), spark.createDataFrame(seen, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    unseen = [i for i in range(len(texts)) if fold(i)]
    assert np.mean([(got[i].score >= 0.7) == bool(labels[i]) for i in unseen]) >= 0.95
    for i in unseen:
        for s in got[i].sentences:
            assert "rotten" in texts[i][s.start : s.end]


def test_noisy_or_of_sentences():
    model = toxicity.Model({"bad": 9.0, "odd*": 0.0}, -6.0)
    p = [1 / (1 + np.exp(6.0)), 1 / (1 + np.exp(-3.0))]
    score, found = model.score("A fine day. A BAD day!\n\n ... 12", 0.5)
    assert score == pytest.approx(1 - (1 - p[0]) * (1 - p[1]))
    assert [(a, b) for a, b, _ in found] == [(11, 21)]


def test_toxicity_edges(spark, docs_of):
    model = toxicity.Model({"bad": 9.0}, -6.0)
    docs = docs_of([None, "", "... 12", "bad", "ok. " * 60_000, "İ bad İ"], [1, 2, 3, 4, None, 5])
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert got[1] == got[2] == got[3] == 0.0 and got[4] > 0.9 and got[5] > 0.9 and 0 <= got[None] <= 1
    assert toxicity.score_documents(docs.filter("false"), model).count() == 0
    empty = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert max(r.score for r in toxicity.score_documents(docs.filter("doc_id = 4"), empty).collect()) < 0.01


@data
def test_toxicity_held_out(spark):
    got = QUERIES["op1_toxicity"](spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    right = sum(r.predicted == r.toxic for r in out)
    assert right >= 0.85 * len(out)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
