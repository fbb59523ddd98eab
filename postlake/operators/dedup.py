"""Keyed dedup, within a run and against stored rows, and set dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    bypass_null_keys: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key — the first by ``order`` (deterministic, G4).

    ``row_number() == 1`` lets Spark put a partial WindowGroupLimit before the
    shuffle: each map task keeps one row per key, so a hot key ships at most
    one row per input partition. Rows whose ``bypass_null_keys`` parts are all
    null skip the dedup (they would otherwise form one hot group) and are
    appended unchanged.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    if bypass_null_keys:
        all_null = F.lit(True)
        for k in bypass_null_keys:
            all_null = all_null & F.col(k).isNull()
        keyed = df.where(~all_null)
        passthrough = df.where(all_null)
    else:
        keyed, passthrough = df, None
    first = keyed.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
    return first if passthrough is None else first.unionByName(passthrough)


#: Bits of one bitmap of Spark's bitmap functions, and bitmaps of a filter at most
#: (8 MB together, which bounds what ``drop_stored`` broadcasts).
BITMAP_BITS, MOST_BITMAPS = 32768, 2048
BITS_A_KEY = 8


def key_bitmaps(df: DataFrame, key_hash: Column, bitmaps: int) -> DataFrame:
    """(bucket, bits): the hashed keys of ``df`` as a Bloom filter of one hash, a row per bitmap."""
    bit = F.pmod(key_hash, F.lit(bitmaps * BITMAP_BITS))
    cells = df.select(F.floor(bit / BITMAP_BITS).alias("bucket"), F.pmod(bit, F.lit(BITMAP_BITS)).alias("at"))
    return cells.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1


def possibly_in(df: DataFrame, key_hash: Column, bitmaps: int, filters: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter: all that are, and few others."""
    bit = F.pmod(key_hash, F.lit(bitmaps * BITMAP_BITS))
    joined = df.withColumn("__bit", bit).join(F.broadcast(filters), F.floor(F.col("__bit") / BITMAP_BITS) == F.col("bucket"))
    return joined.filter(_is_set(F.col("bits"), F.pmod("__bit", F.lit(BITMAP_BITS)))).select(df.columns)


def drop_stored(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A8 across runs: the rows of ``new`` whose ``keys`` no row of ``stored`` has.

    The stored rows are many and the new ones few, so the new keys become a
    Bloom filter (eight bits a key, at most ``MOST_BITMAPS`` bitmaps: its
    broadcast has a fixed bound) that the stored keys pass where they are
    scanned; only what may match is shuffled, to an exact anti join. More new
    keys than the filter is made for let more stored keys through, nothing else
    changes. Null keys equal null keys. Read ``stored`` with partition filters:
    only its key columns and those partitions are scanned.
    """
    hashed = F.xxhash64(*keys)
    size = new.agg(F.approx_count_distinct(hashed)).first()[0]
    bitmaps = min(MOST_BITMAPS, 1 + BITS_A_KEY * size // BITMAP_BITS)
    near = possibly_in(stored.select(*keys), hashed, bitmaps, key_bitmaps(new, hashed, bitmaps))
    near = near.distinct().toDF(*(f"__{k}" for k in keys))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return new.join(near, same, "left_anti")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null, non-empty values (hash aggregate with map-side combine)."""
    return df.select(col).where(F.col(col).isNotNull() & (F.col(col) != "")).distinct()
