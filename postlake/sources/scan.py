"""Recursive scan of a foreign Parquet tree."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("postlake")


def parquet_files(spark: SparkSession, base_path: str) -> DataFrame:
    """(path, length) of every ``*.parquet`` file at or below ``base_path``; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        return reader.load(base_path).select("path", "length")
    except AnalysisException as exc:
        raise FileNotFoundError(f"no parquet files under {base_path}") from exc


def _scan(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", "true")
        .option("ignoreCorruptFiles", "true")
        .parquet(path)
    )


def skipped_files(spark: SparkSession, base_path: str) -> DataFrame:
    """Paths of the files a scan passes over: no row of theirs can be read
    (corrupt, or without rows). Only footers are read; the listing and the list
    of files that gave rows meet in an anti join, nothing is collected."""
    listed = parquet_files(spark, base_path).select("path")
    try:
        read = _scan(spark, base_path).select(F.col("_metadata.file_path").alias("path")).distinct()
    except AnalysisException:
        return listed
    plain = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")  # file:/x and file:///x are one
    return listed.withColumn("__p", plain).join(read.select(plain.alias("__p")), "__p", "left_anti").select("path")


def scan_parquet_tree(spark: SparkSession, base_path: str) -> DataFrame:
    """Every ``*.parquet`` at or below ``base_path``, unioned by column name.

    Unreadable files are skipped (``ignoreCorruptFiles``) and reported: their
    number is logged as a warning and ``skipped_files`` lists them. Columns
    missing in some files come back null (``mergeSchema``). Raises
    ``FileNotFoundError`` when there is no Parquet file and ``ValueError`` when
    none of them can be read. Partition discovery is off with recursive lookup,
    so use ``sinks.read_layer`` for our own partitioned layers and this scan
    only for trees laid out by other tools.
    """
    if parquet_files(spark, base_path).isEmpty():
        raise FileNotFoundError(f"no parquet files under {base_path}")
    try:
        df = _scan(spark, base_path)
    except AnalysisException as exc:
        raise ValueError(f"no readable parquet file under {base_path}") from exc
    if not df.columns:
        raise ValueError(f"no readable parquet file under {base_path}")
    if skipped := skipped_files(spark, base_path).count():
        log.warning("%d parquet files under %s gave no rows", skipped, base_path)
    return df


def scan_tree_by_folder(spark: SparkSession, base_path: str, conform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """S1 for trees whose column types drift between top-level folders (the
    foreign raw layer: one folder per source, a field a string in one source and
    a list in another). Files directly under the root and each folder are read
    on their own (types agree within one), passed through ``conform`` (to a
    canonical schema), and the results are unioned by name. Folders come from
    the path's own file system, so any scheme Spark reads works; a tree has one
    folder per source, and their names are all the driver sees."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base_path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        raise FileNotFoundError(f"no parquet files under {base_path}")
    entries = [(e.getPath().toString(), e.isDirectory()) for e in fs.listStatus(root)]
    parts = []
    for path, is_folder in sorted(entries):
        if is_folder:
            try:
                parts.append(conform(scan_parquet_tree(spark, path)))
            except FileNotFoundError:
                continue
            except ValueError as exc:
                log.warning("%s", exc)
        elif path.endswith(".parquet"):
            try:
                parts.append(conform(_scan(spark, path, recursive=False)))
            except AnalysisException:
                log.warning("%s cannot be read", path)
    if not parts:
        raise FileNotFoundError(f"no readable parquet files under {base_path}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, columns) of each file: names and types from its footer, null where it has none."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        out: list[str | None] = []
        for path in batch.column("path").to_pylist():
            uri = quote(re.sub("^([a-z0-9]+):/+", r"\1:///" if path.startswith("file:") else r"\1://", path), safe=":/")
            try:
                system, name = fs.FileSystem.from_uri(uri)
                with system.open_input_file(name) as source:
                    out.append("; ".join(sorted(f"{f.name} {f.type}" for f in pq.read_schema(source))))
            except (pa.ArrowInvalid, OSError) as exc:
                log.warning("%s: %s", path, exc)
                out.append(None)
        yield pa.record_batch([batch.column("path"), pa.array(out, pa.string())], names=["path", "columns"])


def footer_schemas(spark: SparkSession, base_path: str) -> DataFrame:
    """(path, columns) of every Parquet file below a path: a fingerprint of its
    schema, null for a file without a readable footer. Tasks read footers only."""
    return parquet_files(spark, base_path).select("path").mapInArrow(_footers, "path string, columns string")


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def _common(types: list[T.DataType]) -> T.DataType:
    """The type that all of ``types`` can be brought to without losing a value:
    the widest whole or real number, a list as soon as one is a list, else text."""
    kinds = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(kinds) <= 1:
        return kinds[0] if kinds else T.StringType()
    if any(isinstance(t, T.ArrayType) for t in kinds):
        return T.ArrayType(_common([t.elementType if isinstance(t, T.ArrayType) else t for t in kinds]))
    if all(isinstance(t, _WHOLE) for t in kinds):
        return max(kinds, key=lambda t: _WHOLE.index(type(t)))
    if all(isinstance(t, _REAL) for t in kinds):
        return T.DoubleType()
    return T.StringType()


def _brought_to(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(want, T.ArrayType):
        if isinstance(have, T.ArrayType):
            return F.transform(value, lambda x: _brought_to(x, have.elementType, want.elementType))
        return F.when(value.isNotNull(), F.array(_brought_to(value, have, want.elementType)))
    if isinstance(want, T.StringType) and isinstance(have, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast(want)


def scan_drifting_tree(spark: SparkSession, base_path: str, schema: T.StructType | None = None) -> DataFrame:
    """S1 for trees whose column types drift from file to file, in one folder too.

    Files are grouped by the schema in their footers (read by tasks, footers
    only); each group is one scan, its columns are brought to one type and the
    scans are unioned by name, so the plan grows with the number of different
    schemas and not with the files. ``schema`` names the wanted columns and
    types; without it a column takes the widest number, a list where some file
    has a list (a single value becomes a list of one), else text (nested values
    as JSON). Columns that a file lacks are null. Files without a readable
    footer are passed over, with a warning. Raises ``FileNotFoundError``
    without Parquet files and ``ValueError`` when none can be read. Names of
    files and schemas are all the driver sees. Footers are opened through Arrow's
    file systems (local, HDFS, S3, GCS).
    """
    if parquet_files(spark, base_path).isEmpty():
        raise FileNotFoundError(f"no parquet files under {base_path}")
    found = footer_schemas(spark, base_path).groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    for lost in (r.paths for r in found if r["columns"] is None):
        log.warning("%d parquet files under %s have no readable footer", len(lost), base_path)
    groups = [spark.read.parquet(*r.paths) for r in sorted((r for r in found if r["columns"]), key=lambda r: r.paths)]
    if not groups:
        raise ValueError(f"no readable parquet file under {base_path}")
    if schema is None:
        names = list(dict.fromkeys(c for g in groups for c in g.columns))
        schema = T.StructType([T.StructField(c, _common([g.schema[c].dataType for g in groups if c in g.columns])) for c in names])

    def conformed(group: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in group.schema}
        return group.select(*((_brought_to(group[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))

    out = conformed(groups[0])
    for group in groups[1:]:
        out = out.unionByName(conformed(group))
    return out
