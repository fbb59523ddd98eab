"""Helpers shared by the corpus operators: table reads, shared work tables, folds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import shared_dir

#: Texts handled together inside a task, in UTF-8 bytes (bounds numpy memory).
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: whatever reads the result survives lost executors
    without recomputing, and sees one fixed set of rows.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of materialized tables that nothing will read again.

    Only for tables whose readers' results are themselves materialized: what
    still had to be recomputed after a lost executor would miss them.
    """
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def held_out(doc_id: str, modulus: int) -> Column:
    """True for rows kept out of training: crc32(id as text) mod ``modulus`` is 1.

    A null id is never trained on, so it counts as held out.
    """
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == 1, F.lit(True))


def text_slices(batch: pa.RecordBatch, column: str, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose texts hold about ``budget`` bytes (one row at least)."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > budget:
            yield start, i
            start, total = i, 0
        total += n
    if sizes:
        yield start, len(sizes)
