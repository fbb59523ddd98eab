"""BPE encoding and decoding with a contiguous rank array (operator 3).

A word's parts lie in one contiguous row beside the merge rank of each
adjacent pair. Each step scans the row for the smallest rank (leftmost first),
merges that pair, deletes the boundary between its parts and refreshes the
two neighbouring ranks. Many words are held as rows of one numpy matrix, so
one step serves all of them. Words longer than ``SHORT`` parts, where the scan
would be quadratic, keep the same ranks in a heap over linked parts.

Each distinct word of a task is encoded once (a bounded memo).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm import pretokens
from postlake.llm.common import text_slices

SHORT = 64
#: Distinct words a task remembers; a word takes some 230 bytes with its ids and its decoded text.
MEMO_WORDS = 150_000
#: Texts split into words together, in UTF-8 bytes: as words they take some ten times that.
WORDS_BYTES = 1 << 19
#: Parts stepped together; a part takes some 50 bytes while a step looks its ranks up.
CELLS = 1 << 17
NO_RANK = np.int32(2**31 - 1)
WORD_END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class RankTable:
    """Vocabulary and merges of a word-end BPE file as sorted arrays."""

    def __init__(self, path: str):
        whole = pretokens.definition(path)
        model = whole["model"]
        vocab: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.names = {i: name for name, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + WORD_END] for c in letters], np.int32)
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)  # by rank
        self.pairs: dict[int, int] | None = None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of part ids; NO_RANK where none or a side is missing (-1)."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.rank[at], NO_RANK)

    def encode_short(self, words: list[bytes]) -> list[np.ndarray]:
        """Part ids of words of 1 to SHORT bytes, all stepped together."""
        size = np.array([len(w) for w in words])
        width = int(size.max())
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(len(words)), size)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        parts = np.full((len(words), width + 1), -1, np.int32)
        parts[row, col] = np.where(col == size[row] - 1, self.final[flat], self.inner[flat])
        ranks = np.full((len(words), width + 1), NO_RANK, np.int32)
        ranks[:, :-1] = self.ranks(parts[:, :-1], parts[:, 1:])
        out: list = [None] * len(words)
        which, columns = np.arange(len(words)), np.arange(width)
        while len(which):
            at = ranks.argmin(1)
            rows = np.arange(len(which))
            best = ranks[rows, at]
            done = best == NO_RANK
            if done.any():
                for i in np.flatnonzero(done):
                    ids = parts[i]
                    out[which[i]] = ids[ids >= 0]
                live = ~done
                which, parts, ranks, at, best = which[live], parts[live], ranks[live], at[live], best[live]
                rows = np.arange(len(which))
                if not len(which):
                    break
            parts[rows, at] = self.merged[best]
            # delete the boundary behind the merged part: later entries move one to the left
            source = columns + (columns > at[:, None])
            parts[:, :-1] = np.take_along_axis(parts, source, 1)
            source = columns + (columns >= at[:, None])
            ranks[:, :-1] = np.take_along_axis(ranks, source, 1)
            parts[:, -1], ranks[:, -1] = -1, NO_RANK
            # refresh the two neighbouring ranks
            ranks[rows, at] = self.ranks(parts[rows, at], parts[rows, np.minimum(at + 1, width)])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.ranks(parts[before, at[before] - 1], parts[before, at[before]])
        return out

    def encode_long(self, word: bytes) -> np.ndarray:
        """Part ids of one long word: the same merges from a heap over linked parts."""
        if self.pairs is None:
            self.pairs = dict(zip(self.keys.tolist(), self.rank.tolist(), strict=True))
        ids = self.inner[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self.final[word[-1]])
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]

        def rank(i: int) -> int | None:
            return self.pairs.get((ids[i] << 32) | ids[after[i]]) if i >= 0 and ids[i] >= 0 and after[i] >= 0 else None

        heap = [(r, i) for i in range(len(ids)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if rank(i) != r:
                continue
            gone = after[i]
            ids[i], ids[gone] = int(self.merged[r]), -1
            after[i] = after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            for j in (before[i], i):
                if (r := rank(j)) is not None:
                    heapq.heappush(heap, (r, j))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, np.ndarray]]:
        """(word, part ids) for each word, short ones in groups of like length."""
        by_width: dict[int, list[bytes]] = {}
        for w in words:
            if len(w) > SHORT:
                yield w, self.encode_long(w)
            elif w:
                by_width.setdefault((len(w) + 3) // 4, []).append(w)
        for width, group in by_width.items():
            step = CELLS // (4 * width)
            for i in range(0, len(group), step):
                some = group[i : i + step]
                yield from zip(some, self.encode_short(some), strict=True)


@lru_cache(maxsize=2)
def rank_table(path: str) -> RankTable:
    return RankTable(path)


def _encoder(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank_table(path)
        names = table.names
        known_ids: dict[bytes, bytes] = {}
        known_text: dict[bytes, str] = {}
        for batch in batches:
            for a, b in text_slices(batch, "text", WORDS_BYTES):
                docs = [pretokens.segments(t, path) for t in batch.column("text")[a:b].to_pylist()]
                docs = [[pretokens.word_end(s, path) if i % 2 == 0 else s for i, s in enumerate(d)] for d in docs]
                need: set[bytes] = set()
                for d in docs:
                    need.update(*d[::2])
                new = need - known_ids.keys()
                if len(known_ids) + len(new) > MEMO_WORDS:
                    known_ids.clear()
                    known_text.clear()
                    new = need
                for word, ids in table.encode(new):
                    known_ids[word] = ids.astype("<u4").tobytes()
                    known_text[word] = " ".join([names[i] for i in ids.tolist()])
                all_ids, all_text = [], []
                for d in docs:
                    ids, text = [], []
                    for i, part in enumerate(d):
                        if i % 2:
                            ids.append(table.special[part].to_bytes(4, "little"))
                            text.append(part)
                        else:
                            ids.extend(map(known_ids.__getitem__, part))
                            text.extend(map(known_text.__getitem__, part))
                    all_ids.append(b"".join(ids))
                    all_text.append(" ".join(text))
                yield pa.record_batch([batch.column("doc_id")[a:b], pa.array([len(x) // 4 for x in all_ids], pa.int64()), pa.array(all_ids, pa.binary()), pa.array(all_text, pa.string())], schema=schema)

    return run


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode and decode whole texts: doc_id, n_tokens, ids, decoded.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers;
    ``decoded`` is what the library's decode gives for them with special
    tokens kept (this file has no decoder, so tokens joined by a space).
    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. A null or empty text has no ids and decodes to an empty text.
    Every input row gives one row, repeated rows and null ids included; an
    empty table gives an empty table; long texts and words are encoded whole.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encoder(tokenizer_path), "doc_id long, n_tokens long, ids binary, decoded string")
