"""Toxicity by multiple-instance learning (operator 1).

A document is a bag of sentences. Each sentence has a logistic score from its
words (each word and its first ``STEMS`` letters, so inflected forms share what
is learned); the document's score is their noisy-or, 1 - prod(1 - p). Only
documents carry labels: the noisy-or likelihood is fitted to them, which
teaches the sentence scores, and those then point at the offending sentences.

The fit uses a bounded sample of labelled rows (``FIT_ROWS`` rows a label, of
at most ``FIT_BYTES`` bytes, lowest hash of the text first), so the driver's work and the
broadcast word weights do not grow with the corpus; every document is scored,
whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import materialize, text_slices

FIT_ROWS, FIT_BYTES = 2000, 4096
#: A feature needs so many sample documents to get a weight; weights nearer zero are dropped.
MIN_DOCS, LEAST_WEIGHT = 8, 0.25
STEPS, RATE, DECAY, START = 150, 0.3, 3e-5, -9.0
#: Lengths of the beginnings of a word that are features beside the word.
STEMS = (4, 5)
#: Words whose weight a task remembers.
MEMO_WORDS = 200_000
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
ASCII_WORD = re.compile(r"[a-z]+")


def _lower(text: str) -> str:
    """Lower case of the same length, so offsets hold in the text itself."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


class _WordWeights(dict):
    """Weight of a word, summed over its features when first asked for; mostly 0."""

    def __init__(self, weights: dict[str, float]):
        self.get_weight = weights.get

    def __missing__(self, word: str) -> float:
        get = self.get_weight
        self[word] = total = sum([get(f, 0.0) for f in _features(word)])
        return total


class Model:
    """Feature weights, the weight every sentence starts from, and the noisy-or."""

    def __init__(self, weights: dict[str, float], start: float):
        self.weights, self.start = weights, start
        self.plain = math.log1p(math.exp(start))  # -log(1 - p) of a sentence without a weighted word

    @cached_property
    def words(self) -> _WordWeights:
        return _WordWeights(self.weights)

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "words"}

    def score(self, text: str | None, report: float) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or score and the sentences of at least ``report``: (start, end, p)."""
        total, found = 0.0, []
        if len(self.words) > MEMO_WORDS:
            self.words.clear()
        weight = self.words.__getitem__
        low = _lower(text or "")
        find = (ASCII_WORD if low.isascii() else WORD).findall
        for m in SENTENCE.finditer(low):
            words = set(find(m[0]))
            if not words:
                continue
            got = [*filter(None, map(weight, words))]
            if not got:
                total += self.plain
                continue
            z = self.start + math.fsum(got)  # exact, so the order of the set is of no account
            total += z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
            p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
            if p >= report:
                found.append((m.start(), m.end(), p))
        return -math.expm1(-total), found


def _bags(texts: list[str]) -> list[list[list[str]]]:
    return [[words for s in SENTENCE.findall(_lower(t)) if (words := sorted(set(WORD.findall(s))))] for t in texts]


def fit(texts: list[str], labels: list[int]) -> Model:
    """Gradient ascent on the noisy-or likelihood of the labels (Adam, weight decay)."""
    bags = _bags(texts)
    seen: dict[str, int] = {}
    for bag in bags:
        for f in {f for w in {w for words in bag for w in words} for f in _features(w)}:
            seen[f] = seen.get(f, 0) + 1
    names = sorted(w for w, n in seen.items() if n >= MIN_DOCS)
    place = {w: i for i, w in enumerate(names)}
    words, sentence, owner = [], [], []
    for d, bag in enumerate(bags):
        for s in bag:
            known = [place[f] for w in s for f in _features(w) if f in place]
            words += known
            sentence += [len(owner)] * len(known)
            owner.append(d)
    if not owner or len(set(labels)) < 2:
        return Model({}, START)
    word, sent, doc = np.array(words, np.int64), np.array(sentence, np.int64), np.array(owner)
    y = np.array(labels, float)
    theta = np.zeros(len(names) + 1)
    theta[-1] = START
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weigh = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    for step in range(1, STEPS + 1):
        z = np.clip(theta[-1] + np.bincount(sent, theta[word], len(doc)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        total = np.bincount(doc, np.logaddexp(0, z), len(y))  # -log prod(1 - p)
        pull = np.where(y > 0, 1 / np.expm1(np.clip(total, 1e-9, 500)), -1.0) * weigh
        by_sentence = pull[doc] * p
        grad = np.append(np.bincount(word, by_sentence[sent], len(names)), by_sentence.sum()) / len(y)
        grad[:-1] -= DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model({w: float(x) for w, x in zip(names, theta, strict=False) if abs(x) >= LEAST_WEIGHT}, float(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, max_bytes: int = FIT_BYTES) -> Model:
    """Fit on at most ``rows`` documents of each label, of at most ``max_bytes`` bytes.

    ``labels`` needs doc_id and toxic (0 or 1; nulls and other values are left
    out, several labels of a document count by their largest). Rows are chosen
    by the hash of their text, so repeated texts stand side by side and the
    choice does not depend on the partitioning. No usable label gives a model
    that scores everything near zero.
    """
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", "text").filter((F.octet_length("text") > 0) & (F.octet_length("text") <= max_bytes))
    # hashes choose the sample; only its texts, a bounded number, leave the scan
    hashes = texts.select("doc_id", F.xxhash64("text").alias("hash")).join(known, "doc_id").groupBy("toxic", "hash").agg(F.min("doc_id").alias("doc_id"))
    chosen = [hashes.filter(F.col("toxic") == label).orderBy("hash").limit(rows) for label in (0, 1)]
    chosen = materialize(chosen[0].unionByName(chosen[1]), "toxicity-sample")
    found = texts.withColumn("hash", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "hash"])
    sample = found.select("toxic", "hash", "text").dropDuplicates(["toxic", "hash"]).toArrow().sort_by([("toxic", "ascending"), ("hash", "ascending")])
    bags, marks = sample["text"].to_pylist(), sample["toxic"].to_pylist()
    return fit(bags, marks)


def score_documents(docs: DataFrame, model: Model, report: float = 0.5) -> DataFrame:
    """doc_id, score and the offending sentences of every document.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. ``sentences`` holds (start, end, p) in characters of the text for
    each sentence with p >= ``report``. A null or empty text, or one without a
    word, has score 0. Every input row gives one row, repeated rows and null ids
    included; an empty table gives an empty table; long texts are scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value.score
        for batch in batches:
            for a, b in text_slices(batch, "text"):
                got = [one(t, report) for t in batch.column("text")[a:b].to_pylist()]
                spans = [[{"start": s, "end": e, "p": p} for s, e, p in found] for _, found in got]
                yield pa.record_batch([batch.column("doc_id")[a:b], pa.array([s for s, _ in got], pa.float64()), pa.array(spans, span)], names=["doc_id", "score", "sentences"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double, sentences array<struct<start:int,end:int,p:double>>")
