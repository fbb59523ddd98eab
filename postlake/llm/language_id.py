"""Language identification: naive Bayes over hashed character n-grams (operator 6).

Training is counting, so it uses every labelled document: each task counts
hashed 1- to 3-grams per language with numpy, Spark sums the partial counts, and
the smoothed log-probability matrix (languages x ``BUCKETS``, its size set by
the number of languages and not by the corpus) is broadcast. Scoring hashes a
slice of texts at once, looks the rows of the matrix up and sums them per
document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import materialize, text_slices

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Characters handled at a time; longer texts are summed piece by piece.
PIECE = 1 << 20
LETTER = re.compile(r"[^\W\d_]")  # letters, and numbers such as ½, which are no letters
UNKNOWN = "und"


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place (the last ``order - 1`` have none)."""
    n = len(codes) - order + 1
    h = np.full(n, 0x9E3779B1 * order & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h = (h ^ codes[k : k + n]) * np.uint32(0x01000193)
    return (h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, place, start) of texts laid one after the other, two blanks behind each.

    Long texts come in several pieces that overlap by the blanks' length, so
    every n-gram of a text is seen exactly once.
    """
    parts, size = [], 0
    for place, text in enumerate(texts):
        low = text.lower()
        for at in range(0, len(low), PIECE):
            part = low[at : at + PIECE + max(ORDERS) - 1]
            parts.append((place, part, min(PIECE, len(low) - at)))
            size += len(part)
            if size >= PIECE:
                yield _laid(parts)
                parts, size = [], 0
    if parts:
        yield _laid(parts)


def _laid(parts: list[tuple[int, str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    blank = " " * (max(ORDERS) - 1)
    codes = np.frombuffer("".join([p + blank for _, p, _ in parts]).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(p) + len(blank) for _, p, _ in parts])
    return codes, np.array([i for i, _, _ in parts]), np.cumsum(lengths) - lengths, np.array([n for _, _, n in parts])


def _own(start: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """True at places whose n-gram belongs to a text (not to blanks or an overlap)."""
    step = np.zeros(n + 1, np.int8)
    np.add.at(step, start, 1)
    np.add.at(step, start + own, -1)
    return np.cumsum(step[:-1]).astype(bool)


def _trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for a, b in text_slices(batch, "text"):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang")[a:b].to_pylist(), batch.column("text")[a:b].to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                total = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                total[BUCKETS] += len(texts)
                for codes, _, start, own in _pieces(texts):
                    keep = _own(start, own, len(codes))
                    for order in ORDERS:
                        got = _buckets(codes, order)
                        total[:BUCKETS] += np.bincount(got[keep[: len(got)]], minlength=BUCKETS)
    for lang, total in counts.items():
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used])], names=["lang", "bucket", "n"])


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text or ""))


class Model:
    """Languages and the log-probability row of each bucket."""

    def __init__(self, counts: pa.Table, smoothing: float = 0.5):
        self.langs = sorted(set(counts["lang"].to_pylist()))
        grid = np.zeros((BUCKETS + 1, len(self.langs)))
        place = np.array([self.langs.index(x) for x in counts["lang"].unique().to_pylist()], np.int64)
        code = counts["lang"].combine_chunks().dictionary_encode()
        grid[counts["bucket"].to_numpy(), place[code.indices.to_numpy()]] = counts["n"].to_numpy()
        seen = grid[:BUCKETS] + smoothing
        self.log = np.log(seen / seen.sum(0)).astype(np.float32) if self.langs else np.zeros((BUCKETS, 0), np.float32)
        self.prior = np.log(grid[BUCKETS] / grid[BUCKETS].sum()) if self.langs else np.zeros(0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        total = np.zeros((len(texts), len(self.langs)))
        for codes, place, start, own in _pieces([t or "" for t in texts]):
            rows = np.zeros((len(codes), len(self.langs)), np.float32)
            for order in ORDERS:
                got = _buckets(codes, order)
                rows[: len(got)] += self.log[got]
            rows[~_own(start, own, len(codes))] = 0
            np.add.at(total, place, np.add.reduceat(rows, start, axis=0, dtype=np.float64))
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        total += self.prior
        best = total.argmax(1)
        share = 1 / np.exp(np.minimum(total - total[np.arange(len(texts)), best][:, None], 0)).sum(1)
        named = [has_letter(t) for t in texts]
        return [self.langs[k] if ok else UNKNOWN for k, ok in zip(best, named, strict=True)], [float(s) if ok else 0.0 for s, ok in zip(share, named, strict=True)]


def train(rows: DataFrame) -> Model:
    """A model from all rows (text, lang); null texts and null languages are left out."""
    used = rows.select("text", "lang").filter("text is not null and lang is not null")
    counts = used.mapInArrow(_trainer, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return Model(materialize(counts, "lang-counts").toArrow())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Language per document: doc_id, lang_pred, score (the posterior of lang_pred).

    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. A null text or one without a letter is ``und`` with score 0; ties go
    to the first language in alphabetical order. Every input row gives one row,
    repeated rows and null ids included; an empty table gives an empty table,
    and a model without languages calls everything ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch, "text"):
                langs, scores = shared.value.predict(batch.column("text")[a:b].to_pylist())
                yield pa.record_batch([batch.column("doc_id")[a:b], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, min_score: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at least ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch, "text"):
                langs, scores = shared.value.predict(batch.column("text")[a:b].to_pylist())
                yield batch.slice(a, b - a).filter(pa.array([x != UNKNOWN and s >= min_score for x, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
