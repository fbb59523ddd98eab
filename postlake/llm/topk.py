"""Exact top-k inner products over norm-sorted vectors (operator 9).

Vectors are turned by the SVD basis of the whole set (its d x d Gram matrix is
summed by Spark; the rest is a d x d eigenproblem), so the first coordinates
hold most of every product. Spark range-sorts the vectors by falling length
into blocks. Each query first meets the block of the longest vectors (one block
of at most ``BLOCK_BYTES``, sent to the tasks), which gives its first bound (its
k-th best score so far). Blocks are numbered by falling length, so the blocks
whose greatest length times the query's can reach the bound are ranges of
numbers: they are exploded and joined by number, the others never read. In a
block, candidates are cut by length (Cauchy-Schwarz), then by the partial sum
of the leading coordinates plus the product of the residual lengths; what is
left is scored in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import materialize

#: Vectors of a block, queries of a block, candidates scored at a time.
BLOCK, QUERIES, STEP = 4096, 256, 1024
#: Most bytes of a block's matrix; wider vectors make shorter blocks.
BLOCK_BYTES = 32 << 20
#: Block numbers of a partition: its number times this, plus the place in it.
IN_PART = 1_000_000
#: Share of the energy that the leading coordinates must hold.
ENERGY = 0.8
#: Relative rounding allowance of the floating-point bounds.
SLACK = 1e-9
VECTORS = pa.schema([("id", pa.int64()), ("norm", pa.float64()), ("vec", pa.list_(pa.float64()))])


def _scaled(scale: float):
    """floor(scale * x) of valid vectors, with their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, norms, vectors = [], [], []
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vec").to_pylist(), strict=True):
                if i is None or v is None or None in v:
                    continue
                x = np.floor(scale * np.array(v, float))
                if np.isfinite(x).all():
                    ids.append(i)
                    norms.append(float(np.sqrt(x @ x)))
                    vectors.append(x)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(norms, pa.float64()), pa.array(vectors, pa.list_(pa.float64()))], schema=VECTORS)

    return run


def _grid(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, shorter ones filled up with zeros."""
    out = np.zeros((len(lists), width))
    sizes = lists.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def _gram(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _grid(batch.column("vec"), width)
            total += x.T @ x
        yield pa.record_batch([pa.array(np.arange(width * width), pa.int32()), pa.array(total.ravel())], names=["cell", "value"])

    return run


def rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Orthonormal basis by falling energy, and how many leading coordinates to sum first."""
    cells = vectors.mapInArrow(_gram(width), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    gram = np.zeros(width * width)
    gram[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    energy, basis = np.linalg.eigh(gram.reshape(width, width))
    energy, basis = np.maximum(energy[::-1], 0), basis[:, ::-1]
    share = np.cumsum(energy) / max(energy.sum(), 1e-300)
    return np.ascontiguousarray(basis), int(min(np.searchsorted(share, ENERGY) + 1, width))


def _blocks(width: int, rows: int):
    """Consecutive vectors as one row: (block, top norm, ids, matrix bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                some = batch.slice(a, rows)
                x = _grid(some.column("vec"), width)
                top = max(some.column("norm").to_pylist())
                yield pa.record_batch([pa.array([part * IN_PART + number]), pa.array([top], pa.float64()), pa.array([some.column("id").to_numpy().tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], names=["block", "top", "ids", "rows"])
                number += 1

    return run


BLOCK_TYPE = "block long, top double, ids binary, rows binary"


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 2^53 in unbounded integers, held to 64 bits at the end."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < 2**53:
        return (x @ q).astype(np.int64)
    big = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x]
    return np.array([min(max(v, -(2**63)), 2**63 - 1) for v in big], np.int64)


def search_block(qid: int, q: np.ndarray, bound: float, ids: np.ndarray, x: np.ndarray, turned: np.ndarray, tail: np.ndarray, norms: np.ndarray, basis: np.ndarray, lead: int, k: int) -> list[tuple[int, int]]:
    """The block's best k (score, id) of a query among those that can reach ``bound``."""
    best: list[tuple[int, int]] = []
    length = float(np.sqrt(q @ q))
    head = q @ basis[:, :lead]
    rest = float(np.sqrt(max(length * length - head @ head, 0.0)))
    slack = SLACK * (1 + length)
    for a in range(0, len(ids), STEP):
        if length * norms[a] * (1 + SLACK) < bound:  # vectors come by falling length
            break
        end = a + STEP
        reach = turned[a:end, :lead] @ head + rest * tail[a:end]
        near = a + np.flatnonzero((reach + slack * norms[a:end] >= bound) & (ids[a:end] != qid))
        if len(near):
            best += zip(_exact(q, x[near]).tolist(), ids[near].tolist(), strict=True)
            best = sorted(best, key=lambda s: (-s[0], s[1]))[:k]
            if len(best) == k:
                bound = max(bound, float(best[-1][0]))
    return best


class _Block:
    """A block's vectors, turned, with their lengths and residual lengths."""

    def __init__(self, ids: bytes, rows: bytes, width: int, basis: np.ndarray, lead: int):
        self.ids, self.x = np.frombuffer(ids, np.int64), np.frombuffer(rows).reshape(-1, width)
        self.turned, self.norms = self.x @ basis, np.sqrt((self.x * self.x).sum(1))
        self.tail = np.sqrt(np.maximum(self.norms**2 - (self.turned[:, :lead] ** 2).sum(1), 0))


def _searcher(width: int, basis: np.ndarray, lead: int, k: int, first: tuple[bytes, bytes] | None = None):
    """Query blocks against the block beside them, or all against the block ``first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = _Block(*first, width, basis, lead) if first else None
        for batch in batches:
            for row in batch.to_pylist():
                b = same or _Block(row["ids"], row["rows"], width, basis, lead)
                qids, qs = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["qrows"]).reshape(-1, width)
                bounds = np.full(len(qids), -np.inf) if first else np.frombuffer(row["bounds"])
                out = [(row["qblock"], qid, i, s) for qid, q, bound in zip(qids.tolist(), qs, bounds.tolist(), strict=True) for s, i in search_block(qid, q, bound, b.ids, b.x, b.turned, b.tail, b.norms, basis, lead, k)]
                yield pa.record_batch([pa.array([o[j] for o in out], pa.int64()) for j in range(4)], names=["qblock", "query_id", "vec_id", "score"])

    return run


def _with_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Query blocks with each query's bound and, per block, its greatest length and lowest ratio."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            known = {b["query_id"]: b["bound"] for b in row["known"] or []}
            qids = np.frombuffer(row["qids"], np.int64)
            q = np.frombuffer(row["qrows"]).reshape(len(qids), -1)
            bounds = np.array([known.get(i, -np.inf) for i in qids.tolist()])
            norms = np.sqrt((q * q).sum(1))
            # the shortest candidate length that some query of the block can still use
            need = np.where(bounds > 0, bounds / np.maximum(norms, 1e-300), 0.0).min(initial=np.inf)
            out.append((row["qblock"], row["qids"], row["qrows"], bounds.tobytes(), float(need)))
        yield pa.record_batch([pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64()))], names=["qblock", "qids", "qrows", "bounds", "need"])


def _useful(needs: DataFrame, tops: DataFrame) -> DataFrame:
    """(qblock, block) of the blocks whose longest vector reaches a query block's need.

    One row sums the blocks up by range partition (as many entries as there are
    shuffle partitions); each query block explodes the numbers of the partitions
    that it needs and meets the blocks by number, an equi-join.
    """
    part = F.floor(F.col("block") / IN_PART).alias("part")
    parts = tops.groupBy(part).agg(F.max("top").alias("top"), F.max("block").alias("last"))
    listed = parts.agg(F.collect_list(F.struct("part", "top", "last")).alias("parts"))
    wide = needs.withColumn("parts", listed.scalar())
    ranges = wide.select("qblock", "need", F.explode(F.filter("parts", lambda p: p["top"] * (1 + SLACK) >= F.col("need"))).alias("p"))
    asked = ranges.select("qblock", "need", F.explode(F.sequence(F.col("p.part") * IN_PART, F.col("p.last"))).alias("block"))
    return asked.join(tops, "block").filter(F.col("top") * (1 + SLACK) >= F.col("need")).select("qblock", "block")


def top_k(vectors: DataFrame, id_column: str, vector_column: str, every: int = 100, k: int = 10, scale: float = 1024.0) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products, ties to the smaller id.

    Components become floor(scale * x); queries are the rows whose id is
    divisible by ``every``, candidates all rows but the query's own. Other
    columns are ignored, whatever their names. A null id, a null vector and a
    vector with a null or non-finite component take no part; vectors of unequal
    length count as filled up with zeros; repeated rows are candidates each (a
    row with the query's id is never one), and a repeated query id is searched
    once, with its first vector in array order. Fewer than k candidates give
    fewer rows; an empty table gives an empty table. Scores are held to 64 bits.
    """
    raw = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vec"))
    valid = materialize(raw.mapInArrow(_scaled(scale), "id long, norm double, vec array<double>"), "topk-vectors")
    width = valid.agg(F.max(F.size("vec"))).first()[0] or 1
    basis, lead = rotation(valid, width)
    shared = (width, basis, lead, k)
    sorted_ = valid.repartitionByRange(F.desc("norm"), F.col("id")).sortWithinPartitions(F.desc("norm"), "id")
    blocks = materialize(sorted_.mapInArrow(_blocks(width, max(1, min(BLOCK, BLOCK_BYTES // (8 * width)))), BLOCK_TYPE), "topk-blocks")
    queries = valid.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"), F.max("norm").alias("norm"))
    asked = queries.repartition("id").sortWithinPartitions("id").mapInArrow(_blocks(width, QUERIES), BLOCK_TYPE)
    asked = materialize(asked.select(F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("rows").alias("qrows")), "topk-queries")

    found = "qblock long, query_id long, vec_id long, score long"
    longest = blocks.orderBy("block").select("block", "ids", "rows").limit(1).toArrow().to_pylist()  # one block of BLOCK_BYTES at most
    first = (longest[0]["ids"], longest[0]["rows"]) if longest else (b"", b"")
    seeds = materialize(asked.mapInArrow(_searcher(*shared, first), found), "topk-seeds")
    bound = seeds.groupBy("qblock", "query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("bound")).filter(F.col("n") >= k)
    known = bound.groupBy("qblock").agg(F.collect_list(F.struct("query_id", "bound")).alias("known"))  # QUERIES at most
    ready = materialize(asked.join(known, "qblock", "left").mapInArrow(_with_bounds, "qblock long, qids binary, qrows binary, bounds binary, need double"), "topk-bounds")
    # a stated query set against all rows, in blocks: each query block goes to the blocks it can still use
    tops = blocks.select("block", "top")
    pairs = _useful(ready.select("qblock", "need"), tops).filter(F.col("block") != (longest[0]["block"] if longest else -1))
    work = pairs.join(ready.drop("need"), "qblock").join(blocks.drop("top"), "block")
    rest = work.mapInArrow(_searcher(*shared), found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = seeds.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
