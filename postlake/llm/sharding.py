"""Byte-balanced shards by longest-processing-time scheduling (operator 8).

Equal texts form a group that stays together. Groups, sorted by size, go to
the least-loaded bin through a heap, at two levels that keep the rule and
spread the work: Spark range-sorts the groups by falling size, each task runs
the heap over its run of groups with many bins, and the driver runs the same
heap over the bins, largest first, with the shards. The driver sees at most
``PACKAGES`` bins plus one per partition and shard, whatever the corpus.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import materialize

PACKAGES = 100_000
#: Bytes each row adds to its text.
ROW_BYTES = 8


def _pack(bins: int):
    """The heap over one partition's groups, which come largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * bins
        heap: list[tuple[int, int]] = []
        for batch in batches:
            packages = []
            for total in batch.column("total").to_pylist():
                if len(heap) < bins:
                    load, k = 0, len(heap)
                    heapq.heappush(heap, (total, k))
                else:
                    load, k = heap[0]
                    heapq.heapreplace(heap, (load + total, k))
                packages.append(first + k)
            yield pa.record_batch([batch.column("group"), batch.column("total"), pa.array(packages, pa.int64())], names=["group", "total", "package"])

    return run


def schedule(loads: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """(package, shard) for (package, bytes): largest first to the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for package, size in sorted(loads, key=lambda x: (-x[1], x[0])):
        load, s = heap[0]
        heapq.heapreplace(heap, (load + size, s))
        out.append((package, s))
    return out


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's place among its partition's rows of the same shard."""
    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        places = []
        for s in batch.column("shard").to_pylist():
            places.append(seen.get(s, 0))
            seen[s] = places[-1] + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())], names=[*batch.schema.names, "part", "place"])


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: shards of near-equal bytes, equal texts together.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. size is the text's UTF-8 bytes plus ``ROW_BYTES``; a null text counts
    as empty (size 8, crc 0, grouped with empty texts). slot numbers the rows of
    a shard from 0 without a gap. Every input row gives one row, repeated rows
    and null ids included; equal sizes are ordered by the text's hash, so ties
    do not depend on the partitioning; an empty table gives an empty table.
    A group larger than an even share fills a shard alone.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group"))
    rows = materialize(rows, "shard-rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("total"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = groups.repartitionByRange(partitions, F.desc("total"), F.col("group")).sortWithinPartitions(F.desc("total"), "group")
    packed = materialize(ordered.mapInArrow(_pack(max(shards, PACKAGES // partitions)), "group binary, total long, package long"), "shard-packages")
    loads = packed.groupBy("package").agg(F.sum("total").alias("total")).toArrow()
    plan = schedule(list(zip(loads["package"].to_pylist(), loads["total"].to_pylist(), strict=True)), shards)
    packages, chosen = zip(*plan, strict=True) if plan else ((), ())
    table = spark.createDataFrame(pa.table({"package": pa.array(packages, pa.int64()), "shard": pa.array(chosen, pa.int32())}))
    placed = packed.join(F.broadcast(table), "package").select("group", "shard")
    assigned = rows.join(placed, "group").select("doc_id", "size", "text_crc32", "shard").sortWithinPartitions("shard", "doc_id")
    numbered = materialize(assigned.mapInArrow(_number, "doc_id long, size long, text_crc32 long, shard int, part int, place long"), "shard-slots")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).alias("slot"))
