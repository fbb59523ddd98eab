"""The pipeline against a chain of brute-force stages, and the registered queries."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from postlake.llm import language_id, pretokens
from postlake.llm.common import held_out
from tests.llm.test_line_dedup import brute as lines_left
from tests.llm.test_simhash import brute_components, brute_fingerprint

DATA = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")


def brute_leak(text, items, k=8):
    """A document holds k words of an item in a row (the tables plant verbatim passages)."""
    import re

    def words(t):
        return re.findall(r"[0-9]+(?:[.,:/][0-9]+)*|[^\W\d_]+", t.lower())

    w = words(text or "")
    runs = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    return any(tuple(x[i : i + k]) in runs for x in map(words, items) for i in range(len(x) - k + 1))


@data
def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    model = language_id.train(docs.filter(~held_out("doc_id", 3)))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    langs, scores = model.predict([t for _, t in rows])
    rows = [r for r, x, s in zip(rows, langs, scores, strict=True) if x != "und" and s >= 0.5]
    rows = list(zip([i for i, _ in rows], lines_left(rows), strict=True))
    comps = brute_components([i for i, _ in rows], [brute_fingerprint(t) for _, t in rows])
    rows = [r for r, c in zip(rows, comps, strict=True) if r[0] == c]
    rows = [r for r in rows if not brute_leak(r[1], items)]
    lib = pretokens.library(public_tokenizers.path("word_bpe_49k.json"))
    expected = {}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == expected


@data
def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).dtypes == docs.dtypes


def test_stages_on_odd_rows(spark, docs_of):
    texts = [None, "", "12 34", "le chat et la souris " * 20, "le chat et la souris " * 20, "the cat and the mouse " * 30]
    docs = docs_of(texts, [1, 2, 3, 7, 7, None], lang=["fr", "en", "en", "fr", "fr", "en"], source=["s"] * 6, n_chars=[0] * 6, score=["x"] * 6)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in docs.collect()) == [(0, True), (7, True)]
    empty = docs_of([], [], lang=[], source=[], n_chars=[])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, DATA)
    assert empty.count() == 0


@data
@pytest.mark.parametrize("name", ["op4_line_dedup", "op7_decontamination", "op9_topk", "op13_lexical"])
def test_queries_equal_their_sql(spark, name):
    import check_oracle

    assert check_oracle.run_checks(spark, DATA, [name], verbose=False) == {name: "ok"}
