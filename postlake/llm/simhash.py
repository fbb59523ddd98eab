"""SimHash near-duplicates linked through BK-trees (operator 5).

Fingerprints that differ in at most ``max_bits`` bits agree on at least
``blocks - max_bits`` of ``blocks`` bit blocks, so fingerprints are dealt to
one shard per choice of that many blocks and its value; every link lies
inside a shard. A shard becomes one or more BK-trees of at most ``TREE``
nodes (a child hangs at its integer Hamming distance to the parent), and each
tree is sent to every part of its own shard, which looks its fingerprints up
by following only edges within the radius. Trees go only to the parts that
can match them, so no broadcast grows with the corpus. A task keeps a union of
what it links and emits at most one edge per fingerprint: dense groups never
become all their pairs, and no connection is lost. Many small shards of a task
are built and searched together as one forest in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import materialize, text_slices
from postlake.llm.components import components

#: Most fingerprints of one tree; a larger shard becomes several trees.
TREE = 4096
#: Fingerprints of a task that are linked together, and node visits at a time.
FOREST, VISITS = 100_000, 1_000_000
SEED = 42
#: Texts whose shingles are held together, in UTF-8 bytes: a shingle takes some 200 bytes as digest and bits.
SHINGLED_BYTES = 1 << 18
#: Parts over which a component's result is dealt back to its fingerprints.
SALTS = 32


def _shingle_digests(text: bytes, width: int) -> list[bytes]:
    """Big-endian XXH64 of each shingle of the text's words (ASCII white space and case)."""
    import xxhash

    words = text.lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_digest
    line = b" ".join(words)
    if len(words) <= width:
        return [digest(line, SEED)]
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(line)]
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)]


def fingerprints_of(texts: list[bytes], width: int) -> np.ndarray:
    """Signed 64-bit SimHash of each text; zero for a text without words."""
    digests = [_shingle_digests(t, width) for t in texts]
    sizes = np.array([len(d) for d in digests])
    out = np.zeros(len(texts), np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(np.frombuffer(b"".join(b"".join(digests[i]) for i in full), np.uint8).reshape(-1, 8), axis=1)
        counts = np.add.reduceat(bits, np.cumsum(sizes[full]) - sizes[full], axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * counts > sizes[full][:, None], axis=1).view(">i8").ravel()
    return out


def _fingerprinter(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [c for c in batch.schema.names if c != "text"]
            for a, b in text_slices(batch, "text", SHINGLED_BYTES):
                texts = batch.column("text")[a:b].cast(pa.binary()).to_pylist()
                yield pa.record_batch([*(batch.column(c)[a:b] for c in keys), pa.array(fingerprints_of(texts, width))], names=[*keys, "fp"])

    return run


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, row, fp) of whole texts; null texts count as empty. ``row`` is a hash of id and text."""
    doc = F.col("doc_id").cast("long")
    rows = docs.select(doc.alias("doc_id"), F.xxhash64(doc, _text()).alias("row"), _text().alias("text"))
    return rows.mapInArrow(_fingerprinter(width), "doc_id long, row long, fp long")


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distance; unsigned, as numpy counts the bits of a signed value's magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)


class Forest:
    """BK-trees of many groups at once: node i is fingerprint i, roots by group."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        self.values = values
        n = len(values)
        _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
        self.root = first[inverse]
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        waiting = np.flatnonzero(self.root != np.arange(n))
        below = self.root[waiting]
        while len(waiting):
            distance = bits_apart(values[waiting], values[below])
            _, first, inverse = np.unique(below * 65 + distance, return_index=True, return_inverse=True)
            chosen = waiting[first]
            parent[chosen], edge[chosen] = below[first], distance[first]
            below = chosen[inverse]
            waiting, below = waiting[waiting != below], below[waiting != below]
        self.child = np.flatnonzero(parent >= 0)
        key = parent[self.child] * 65 + edge[self.child]
        order = np.argsort(key, kind="stable")
        self.child, self.key = self.child[order], key[order]

    def visit(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query place, node) pairs within the radius, level by level."""
        place, node = np.arange(len(queries)), roots
        while len(place):
            if len(place) > VISITS:
                half = len(place) // 2
                rest = [(place[:half], node[:half]), (place[half:], node[half:])]
            else:
                rest = [(place, node)]
            grown = []
            for p, v in rest:
                distance = bits_apart(queries[p], self.values[v])
                near = distance <= radius
                if near.any():
                    yield p[near], v[near]
                low = np.searchsorted(self.key, v * 65 + np.maximum(distance - radius, 0))
                size = np.searchsorted(self.key, v * 65 + np.minimum(distance + radius, 64), "right") - low
                at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
                grown.append((np.repeat(p, size), self.child[at]))
            place, node = (np.concatenate(x) for x in zip(*grown, strict=True))


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the pairs (a, b) in a forest of parents, smaller place on top."""
    while len(a):
        while not np.array_equal(parent, up := parent[parent]):
            parent[:] = up
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def link_groups(values: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of near fingerprints in each group.

    ``side`` 0 rows make the group's tree; side 0 looks itself up in it when it
    stands alone, side 1 rows (another part of the shard) otherwise.
    """
    in_tree = np.flatnonzero(side == 0)
    forest = Forest(values[in_tree], group[in_tree])
    others = np.flatnonzero(side == 1)
    with_others = np.isin(group[in_tree], group[others])
    asking = np.concatenate([in_tree[~with_others], others])
    names, first = np.unique(group[in_tree], return_index=True)
    known = np.isin(group[asking], names)
    asking = asking[known]
    roots = forest.root[first[np.searchsorted(names, group[asking])]]
    parent = np.arange(len(values))
    step = max(1, VISITS // max(1, np.bincount(forest.root).max(initial=1)))
    step = max(step, 256)
    for i in range(0, len(asking), step):
        some = asking[i : i + step]
        for place, node in forest.visit(values[some], roots[i : i + step], radius):
            _merge(parent, some[place], in_tree[node])
    while not np.array_equal(parent, up := parent[parent]):
        parent = up
    moved = np.flatnonzero(parent != np.arange(len(values)))
    return values[moved], values[parent[moved]]


def _linker(radius: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(rows: pa.Table) -> pa.RecordBatch:
        shard, i, j, side, fp = (rows.column(c).to_numpy() for c in ("shard", "i", "j", "side", "fp"))
        new = np.ones(len(fp), bool)
        new[1:] = (shard[1:] != shard[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        u, v = link_groups(fp, np.cumsum(new), side, radius)
        return pa.record_batch([pa.array(u), pa.array(v)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < FOREST:
                continue
            rows = pa.Table.from_batches(held)
            keys = [rows.column(c).to_numpy() for c in ("shard", "i", "j")]
            starts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            if len(starts):  # the last group may go on in the next batch
                yield links(rows.slice(0, starts[-1]))
                held = rows.slice(starts[-1]).to_batches()
        if held and (rows := pa.Table.from_batches(held)).num_rows:
            yield links(rows)

    return run


def _shards(blocks: int, same: int) -> Column:
    """One shard number per choice of ``same`` of the ``blocks`` bit blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    out = []
    for number, chosen in enumerate(combinations(range(blocks), same)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    return F.array(*out)


def near_links(distinct: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(u, v) links that connect all fingerprints within ``max_bits`` of each other."""
    dealt = distinct.select("fp", F.explode(_shards(blocks, blocks - max_bits)).alias("shard"))
    sizes = dealt.groupBy("shard").agg(F.count("*").alias("size")).filter("size > 1")
    dealt = dealt.join(sizes, "shard").withColumn("parts", F.ceil(F.col("size") / TREE)).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    # a part meets every part of its shard: tree of the lower number, look-ups of the higher
    paired = dealt.select("shard", "fp", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    i, j = F.least("part", "other"), F.greatest("part", "other")
    paired = paired.select("shard", i.alias("i"), j.alias("j"), F.when(F.col("part") == i, 0).otherwise(1).alias("side"), "fp")
    together = paired.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j", "fp")
    return together.mapInArrow(_linker(max_bits), "u long, v long")


def _placed(distinct: DataFrame, width_bits: tuple[int, int], value: str) -> DataFrame:
    """(fp, best): the least ``value`` of a fingerprint's whole component, for fingerprints ``distinct`` (fp, value).

    Unlinked fingerprints keep their own. A component's least value is folded
    before the shuffle and dealt back over ``SALTS`` parts, so that a large
    component is not one task.
    """
    max_bits, blocks = width_bits
    moved = components(near_links(distinct.select("fp"), max_bits, blocks)).toDF("fp", "root")
    # the root itself is no row of the links' result
    nodes = materialize(moved.unionByName(moved.select(F.col("root").alias("fp"), "root").distinct()), "simhash-nodes")
    linked = nodes.join(distinct, "fp")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    least = linked.groupBy("root").agg(F.min(value).alias("best")).select("root", "best", salts)
    salt = F.pmod(F.hash("fp"), F.lit(SALTS)).alias("salt")
    best = nodes.select("fp", "root", salt).join(least, ["root", "salt"]).select("fp", "best")
    own = distinct.join(nodes.select("fp"), "fp", "left_anti").select("fp", F.col(value).alias("best"))
    return best.unionByName(own)


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """Near-duplicate groups: doc_id, fp, fingerprint (hex), component_id.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. Words are runs without ASCII white space, A-Z lower-cased; a text
    with fewer words than a shingle is one shingle; a null, empty or blank text
    has fingerprint zero and links like any other. component_id is the smallest
    doc_id reachable (null ids are passed over; a component of null ids alone
    has null). Every input row gives one row, repeated rows included; an empty
    table gives an empty table. ``blocks`` sets the shard size: more blocks than
    ``max_bits + 1`` give finer shards and more copies of each fingerprint.
    """
    fps = materialize(fingerprints(docs, width), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    member = _placed(distinct, (max_bits, blocks or max_bits + 1), "low").withColumnRenamed("best", "component_id")
    return fps.join(member, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Rows up to which the list of dropped documents is broadcast after it was counted (16 bytes each).
BROADCAST_ROWS = 500_000


def _small(df: DataFrame, purpose: str) -> DataFrame:
    df = materialize(df, purpose)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def keep_one(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs``, all columns, with one row of each near-duplicate group.

    The row with the smallest doc_id stays (null ids come last, then the smaller
    hash of id and text). Groups are of rows, so unrelated texts that share an
    id all stay. Of rows that repeat id and text, the one whose other columns
    are least as JSON stays. ``docs`` may hold any columns but ``__row`` and
    ``__gone``.
    """
    fps = materialize(fingerprints(docs, width), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "row")
    distinct = fps.groupBy("fp").agg(F.min(order).alias("low"))
    best = _placed(distinct, (max_bits, max_bits + 1), "low").select("fp", F.col("best.row").alias("stays"))
    rows = fps.groupBy("row", "fp").agg(F.count("*").alias("n"))
    judged = materialize(rows.join(best, "fp").select("row", "n", (F.col("row") != F.col("stays")).alias("goes")), "simhash-judged")
    gone = _small(judged.filter("goes").select(F.col("row").alias("__gone")).distinct(), "simhash-gone")
    twice = _small(judged.filter("n > 1 and not goes").select(F.col("row").alias("__gone")).distinct(), "simhash-twice")
    keyed = docs.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), _text()))
    kept = keyed.join(gone, F.col("__row") == F.col("__gone"), "left_anti")
    once = kept.join(twice, F.col("__row") == F.col("__gone"), "left_anti").select(docs.columns)
    again = kept.join(twice, F.col("__row") == F.col("__gone"), "left_semi")
    others = [c for c in docs.columns if c not in {"doc_id", "text"}]
    ranked = F.to_json(F.struct(*others)) if others else F.lit("")
    first = again.groupBy("__row").agg(F.min_by(F.struct(*docs.columns), ranked).alias("first"))
    return once.unionByName(first.select("first.*").select(docs.columns))
