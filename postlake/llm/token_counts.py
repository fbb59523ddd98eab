"""Token counts per document without materialising ids (operator 2).

Pieces are counted once per distinct pre-token and joined to the pre-token
frequencies of each document:

1. one pass over the texts gives the corpus frequency of every pre-token
   (combined inside each task, then by Spark);
2. the library counts the pieces of each distinct pre-token, once, and the
   table goes to the shared folder;
3. a second pass builds each document's pre-token frequencies. The most
   frequent pre-tokens (``hot``, at most ``HOT_BYTES`` long each, so the
   broadcast has a fixed bound whatever the corpus) meet their piece counts
   in the task; all others leave as (row, pre-token, n) and meet them in a
   shuffle join. Both parts are summed per document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm import pretokens
from postlake.llm.common import materialize, text_slices

#: Broadcast bound: so many pre-tokens of at most so many bytes each.
HOT_TOKENS, HOT_BYTES = 400_000, 64
#: Distinct pre-tokens a task holds before it passes its partial counts on.
FLUSH = 400_000
PIECES = pa.schema([("token", pa.string()), ("n", pa.int64())])
PARTS = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("known", pa.int64()), ("token", pa.string()), ("n", pa.int64())])


def _count_rows(counts: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=PIECES)


def _corpus_frequencies(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for a, b in text_slices(batch, "text"):
                for text in batch.column("text")[a:b].to_pylist():
                    for part in pretokens.segments(text, path)[::2]:
                        counts.update(pretokens.byte_level(part, path))
                if len(counts) > FLUSH:
                    yield _count_rows(counts)
                    counts = Counter()
        if counts:
            yield _count_rows(counts)

    return run


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = pretokens.library(path)
        for batch in batches:
            got = tok.encode_batch_fast(batch.column("token").to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(e.ids) for e in got], pa.int64())], names=["token", "n", "pieces"])

    return run


def _document_frequencies(path: str, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = hot.value.get
        for batch in batches:
            for a, b in text_slices(batch, "text"):
                part = batch.slice(a, b - a)
                rids, texts = part.column("rid").to_pylist(), part.column("text").to_pylist()
                known, rare_rid, rare_token, rare_n = [], [], [], []
                for rid, text in zip(rids, texts, strict=True):
                    cut = pretokens.segments(text, path)
                    total, seen = len(cut) // 2, Counter()
                    for plain in cut[::2]:
                        seen.update(pretokens.byte_level(plain, path))
                    for token, n in seen.items():
                        p = pieces(token)
                        if p is None:
                            rare_rid.append(rid)
                            rare_token.append(token)
                            rare_n.append(n)
                        else:
                            total += n * p
                    known.append(total)
                heads = [part.column("rid"), part.column("doc_id"), pa.compute.binary_length(part.column("text")).cast(pa.int64()), pa.array(known, pa.int64()), pa.nulls(len(known), pa.string()), pa.nulls(len(known), pa.int64())]
                yield pa.record_batch(heads, schema=PARTS)
                if rare_rid:
                    none = pa.nulls(len(rare_rid), pa.int64())
                    yield pa.record_batch([pa.array(rare_rid, pa.int64()), none, none, none, pa.array(rare_token, pa.string()), pa.array(rare_n, pa.int64())], schema=PARTS)

    return run


def piece_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(token, n, pieces) of every distinct pre-token: corpus frequency and piece count."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    counts = texts.mapInArrow(_corpus_frequencies(tokenizer_path), "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return materialize(counts.mapInArrow(_pieces(tokenizer_path), "token string, n long, pieces long"), "token-pieces")


def count_tokens(docs: DataFrame, tokenizer_path: str, max_tokens: int = 1024, hot: int = HOT_TOKENS) -> DataFrame:
    """Tokens per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > max_tokens).

    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. A null or empty text has 0 bytes and 0 tokens. Every input row
    gives one output row, repeated rows and null ids included; an empty table
    gives an empty table. Texts of any length are counted whole. A special
    string inside a text counts as its one token, as by the library's default.
    """
    pieces = piece_table(docs, tokenizer_path)
    top = pieces.filter(F.octet_length("token") <= HOT_BYTES).orderBy(F.desc("n"), "token").limit(hot).select("token", "pieces").toArrow()
    known = docs.sparkSession.sparkContext.broadcast(dict(zip(top["token"].to_pylist(), top["pieces"].to_pylist(), strict=True)))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = materialize(rows.mapInArrow(_document_frequencies(tokenizer_path, known), "rid long, doc_id long, n_bytes long, known long, token string, n long"), "token-parts")
    heads = parts.filter("token is null").select("rid", "doc_id", "n_bytes", "known")
    rare = parts.filter("token is not null").select("rid", "token", "n").join(pieces.select("token", "pieces"), "token")
    rare = rare.select("rid", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("known"))
    total = heads.unionByName(rare).groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("known").alias("n_tokens"))
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit"))
