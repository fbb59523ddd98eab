"""Ranked lexical search by dense blocked matrix products (operator 13).

Items (a stated query set) are dealt to blocks of bounded vocabulary. For each
block, Spark reads the documents once and writes, per document, its term count
and the frequencies of the block's terms. Document counts and frequencies are
summed from that; they fix each term's weight and each document's impacts.

Scoring multiplies tiles: impacts of DOCS documents by VOCABULARY terms, times
weights of these terms by ITEMS items, in float64 BLAS. A vocabulary tile ends
where a partial sum could pass 2^53, so each product is an exact integer; tiles
add up in 64-bit integers. A tile hands on only what reaches an item's tenth
score so far, equal scores included, and a task keeps ten documents an item.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import materialize

#: Documents, vocabulary terms and items of a tile.
DOCS, VOCABULARY, ITEMS = 1024, 1024, 512
#: Items of a block, and bytes of item texts at which a block ends (one item at least).
BLOCK_ITEMS, BLOCK_BYTES = 4096, 4 << 20
EXACT = 2**53
#: Greatest impact: 1000000000 tf div (1000 tf + 8 m) stays below this.
IMPACT = 1_000_000
# Length normalisation of the ranking formula.
B, K, SCALE = 75, 8, 1_000_000_000
#: ASCII letters (A-Z lower-cased) and digits, and bytes of other characters.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split() if text else []


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in runs of BLOCK_ITEMS items or BLOCK_BYTES bytes, numbered within the partition."""
    number, count, size = 0, 0, 0
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            n = len(text.encode())
            if count and (count >= BLOCK_ITEMS or size + n > BLOCK_BYTES):
                number, count, size = number + 1, 0, 0
            count, size = count + 1, size + n
            out.append(number)
        yield pa.record_batch([pa.array(out, pa.int64()), batch.column("row"), batch.column("item_id"), batch.column("text")], names=["block", "row", "item_id", "text"])


class Block:
    """Items of one block: their terms as numbers of a compact vocabulary, with repeats counted."""

    def __init__(self, texts: list[str]):
        counts = [Counter(terms_of(t)) for t in texts]
        self.vocabulary = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        cells = [(self.vocabulary[t], item, n) for item, c in enumerate(counts) for t, n in c.items()]
        cells.sort()
        self.term, self.item, self.times = (np.array([c[j] for c in cells], np.int64) for j in range(3))
        self.items = len(texts)


COUNTED = "doc_id long, n long, terms array<int>, times array<int>"


def _counter(vocabulary: dict[bytes, int]):
    """(doc_id, n, terms, times) of each document with a term; terms are the vocabulary's, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = vocabulary.get
        for batch in batches:
            ids, sizes, terms, times = [], [], [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                known = np.array([k for k in map(of, words) if k is not None], np.int64)
                which, count = np.unique(known, return_counts=True)
                ids.append(i)
                sizes.append(len(words))
                terms.append(which.astype(np.int32))
                times.append(count.astype(np.int32))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "times"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents) summed within the task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        terms = batch.column("terms").flatten().to_numpy()
        more = np.bincount(terms, minlength=len(total))
        more[: len(total)] += total
        total = more
    term = np.flatnonzero(total)
    yield pa.record_batch([pa.array(term, pa.int32()), pa.array(total[term])], names=["term", "df"])


def vocabulary_tiles(term: np.ndarray, item: np.ndarray, gain: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Term ranges [a, b) of at most VOCABULARY terms in which no item's partial sum can reach EXACT.

    ``gain`` is weight times repeats of each (term, item) cell, cells by term.
    A single term beyond the bound is a tile of its own.
    """
    tiles, start = [], 0
    bounds = np.searchsorted(term, np.arange(size + 1))
    reach: dict[int, int] = {}
    for t in range(size):
        mine = list(zip(item[bounds[t] : bounds[t + 1]].tolist(), gain[bounds[t] : bounds[t + 1]].tolist(), strict=True))
        if t > start and (t - start >= VOCABULARY or any((reach.get(i, 0) + g) * IMPACT >= EXACT for i, g in mine)):
            tiles.append((start, t))
            start, reach = t, {}
        for i, g in mine:
            reach[i] = reach.get(i, 0) + g
    return [*tiles, (start, size)] if size else []


def best_of(item: np.ndarray, doc: np.ndarray, null: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each item's k best: higher scores, then smaller ids, null ids last."""
    order = np.lexsort((doc, null, -score, item))
    sorted_ = item[order]
    first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else np.zeros(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank < k]


def _scorer(block: Block, weight: np.ndarray, documents: int, all_terms: int, k: int):
    """Each task's k best documents of every item, by products of tiles."""
    gain = weight[block.term] * block.times
    tiles = vocabulary_tiles(block.term, block.item, gain, len(weight))
    matrices = []
    for a, b in tiles:
        lo, hi = np.searchsorted(block.term, (a, b))
        matrices.append((lo, hi))

    def products(row: np.ndarray, term: np.ndarray, impact: np.ndarray, rows: int, first: int, last: int) -> np.ndarray:
        """Scores of ``rows`` documents and the items [first, last)."""
        total = np.zeros((rows, last - first), np.int64)
        for (a, b), (lo, hi) in zip(tiles, matrices, strict=True):
            here = (term >= a) & (term < b)
            if not here.any():
                continue
            mine = (block.item[lo:hi] >= first) & (block.item[lo:hi] < last)
            t, i, g = block.term[lo:hi][mine], block.item[lo:hi][mine], gain[lo:hi][mine]
            if b - a == 1 and g.max(initial=0) * IMPACT >= EXACT:  # beyond exact doubles: one term, in integers
                line, column = np.zeros(rows, np.int64), np.zeros(last - first, np.int64)
                line[row[here]], column[i - first] = impact[here], g
                total += line[:, None] * column
                continue
            left, right = np.zeros((rows, b - a)), np.zeros((b - a, last - first))
            left[row[here], term[here] - a] = impact[here]
            right[t - a, i - first] = g
            total += (left @ right).astype(np.int64)
        return total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = np.ones(block.items, np.int64)  # the score to reach: the k-th so far, 1 before
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
        for batch in batches:
            for a in range(0, batch.num_rows, DOCS):
                some = batch.slice(a, DOCS)
                ids = some.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                doc = ids.fill_null(0).to_numpy()
                n = some.column("n").to_numpy()
                row = np.repeat(np.arange(some.num_rows), some.column("terms").value_lengths().to_numpy())
                term = some.column("terms").flatten().to_numpy()
                tf = some.column("times").flatten().to_numpy().astype(np.int64)
                m = 100 - B + (B * n * documents) // all_terms
                impact = (SCALE * tf) // (1000 * tf + K * m[row])
                for first in range(0, block.items, ITEMS):
                    last = min(first + ITEMS, block.items)
                    score = products(row, term, impact, some.num_rows, first, last)
                    r, i = np.nonzero(score >= bound[first:last])
                    if not len(r):
                        continue
                    new = (i + first, doc[r], null[r], score[r, i])
                    kept = [np.concatenate(pair) for pair in zip(kept, new, strict=True)]
                    best = best_of(*kept, k)
                    kept = [c[best] for c in kept]
                    full = np.bincount(kept[0], minlength=block.items) == k
                    least = np.full(block.items, np.iinfo(np.int64).max)
                    np.minimum.at(least, kept[0], kept[3])
                    bound = np.where(full, least, 1)
        item, doc, null, score = kept
        yield pa.record_batch([pa.array(item, pa.int32()), pa.array(doc, mask=null), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def _rank_block(texts: DataFrame, block: Block, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each task, for the items of a block."""
    counted = materialize(texts.mapInArrow(_counter(block.vocabulary), COUNTED), "lexical-terms")
    documents, all_terms = counted.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(block.vocabulary), np.int64)
    found = counted.select("terms").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # the block's vocabulary at most
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    return counted.mapInArrow(_scorer(block, weight, documents, max(all_terms or 0, 1), k), "item int, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Each item's k best documents: item_id, rank, doc_id, score; equal scores by ascending doc_id.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are
    ignored, whatever their names. Every document row is ranked and counts in the
    statistics, repeated ones too; a null id ranks behind others of its score. A
    null or termless text is no document, a null or termless item has no rows.
    Rows that repeat an item's id and text are one item; an id with several texts
    is ranked once for each. Fewer than k documents with a score above 0 give
    fewer rows; an empty table on either side gives an empty table.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct()
    asked = asked.withColumn("row", F.xxhash64("item_id", "text"))
    blocked = asked.repartitionByRange("item_id", "row").sortWithinPartitions("item_id", "row").mapInArrow(_blocks, "block long, row long, item_id long, text string")
    blocked = materialize(blocked.withColumn("block", F.col("block") + F.spark_partition_id() * F.lit(1 << 32)), "lexical-items")
    counts = [r for r in blocked.groupBy("block").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).orderBy("block").collect()]
    ranked = None
    for group in _joined([(r.block, r.n, r.size) for r in counts]):  # one pass over the documents a block
        rows = blocked.filter(F.col("block").isin(group)).orderBy("item_id", "row").collect()  # bounded by the block
        block = Block([r.text for r in rows])
        names = spark.createDataFrame([(k_, r.row, r.item_id) for k_, r in enumerate(rows)], "item int, row long, item_id long")
        best = materialize(_rank_block(texts, block, k), "lexical-best").join(names, "item")
        ranked = best if ranked is None else ranked.unionByName(best)
    if ranked is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id", "row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return placed.select("item_id", "rank", "doc_id", "score")


def _joined(blocks: list[tuple[int, int, int]]) -> Iterator[list[int]]:
    """Small neighbouring blocks taken together, within the same limits."""
    group, count, size = [], 0, 0
    for block, n, n_bytes in blocks:
        if group and (count + n > BLOCK_ITEMS or size + n_bytes > BLOCK_BYTES):
            yield group
            group, count, size = [], 0, 0
        group, count, size = [*group, block], count + n, size + n_bytes
    if group:
        yield group
