"""Operators 2 and 3 against the tokenizers library itself."""

import random

import numpy as np
import public_tokenizers
import pytest
from postlake.llm import pretokens, rank_bpe, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = "aàbAÀZé'’ſ st12½ \n\t\x1c_-!«»—ñßİΣσς漢字😀عא้̀"


def odd_texts(n=120):
    rng = random.Random(7)
    made = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return made + [None, "", " ", "\n\n", "a<|endoftext|> b <|startoftext|><|endoftext|>", "x" * 700, "ab" * 900 + "'s don't", "Hello  World", "Hello  World", "word " * 5000]


@pytest.fixture(scope="module")
def texts():
    return odd_texts()


def test_token_counts_equal_the_library(spark, docs_of, texts):
    lib = pretokens.library(BYTES)
    docs = docs_of(texts, n_tokens=["x"] * len(texts), token=["y"] * len(texts))
    for hot in (0, 50, token_counts.HOT_TOKENS):  # all joined, mixed, all broadcast
        got = {r.doc_id: r for r in token_counts.count_tokens(docs, BYTES, 100, hot).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            n = len(lib.encode(t or "", add_special_tokens=False).ids)
            assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 100), t


def test_token_counts_of_repeated_null_and_no_rows(spark, docs_of):
    rows = token_counts.count_tokens(docs_of(["a b", "a b", None], [1, 1, None]), BYTES).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == [(-1, 0), (1, 2), (1, 2)]
    assert token_counts.count_tokens(docs_of([]), BYTES).count() == 0


def test_bpe_equals_the_library(spark, docs_of, texts):
    lib = pretokens.library(WORDS)
    got = {r.doc_id: r for r in rank_bpe.encode_documents(docs_of(texts, ids=None, decoded=["x"] * len(texts)), WORDS).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(got[i].ids), "<u4").tolist() == ids
        assert got[i].n_tokens == len(ids)
        assert got[i].decoded == lib.decode(ids, skip_special_tokens=False)


def test_bpe_of_no_rows(spark, docs_of):
    assert rank_bpe.encode_documents(docs_of([]), WORDS).count() == 0


def test_rank_array_and_heap_agree():
    table = rank_bpe.rank_table(WORDS)
    rng = random.Random(3)
    words = [bytes(rng.choice(b"aeinorst\xc3\xa9") for _ in range(rng.randint(1, 64))) for _ in range(400)]
    for word, ids in zip(words, table.encode_short(words), strict=True):
        assert ids.tolist() == table.encode_long(word).tolist()


def test_memo_is_bounded(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(rank_bpe, "MEMO_WORDS", 3)
    batch = pa.record_batch([pa.array([1, 2], pa.int64()), pa.array(["one two three four", "five one"])], names=["doc_id", "text"])
    out = list(rank_bpe._encoder(WORDS)(iter([batch])))
    lib = pretokens.library(WORDS)
    assert [lib.decode(np.frombuffer(x, "<u4").tolist()) for b in out for x in b["ids"].to_pylist()] == ["one</w> two</w> three</w> four</w>", "five</w> one</w>"]


def test_an_encoder_holds_little_memory():
    """Python allocations of one task; before, 2 MB of words and 16,384 of them as a matrix were held, with the whole file."""
    import random
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("etaoinshr", k=rng.randint(5, 40))) for _ in range(2000)) + " ½" for _ in range(60)]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    rank_bpe.rank_table.cache_clear()
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in rank_bpe._encoder(WORDS)(iter([batch])))
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert rows == len(texts)
    assert most < 62 << 20, (held >> 20, most >> 20)


@pytest.mark.parametrize("text", ["Ａｂ ½ ǅ", "a b́É", "İI ٣٤ Ⅷ x²", "\x1c\x1fq 中文 한국"])
def test_normalizer_without_vocabulary_equals_the_library(text):
    assert pretokens.normalizer(WORDS).normalize_str(text) == pretokens.library(WORDS).normalizer.normalize_str(text)
