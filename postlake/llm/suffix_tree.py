"""Language-model scores from a probabilistic suffix tree (operator 10).

Symbols are the bytes of a text's token sequence: words (A-Z lower-cased) with
a blank between them and a line end for the end token. Spark counts every run
of ``DEPTH + 1`` symbols of all texts; each shorter context's counts are sums
of those of the training texts. A context seen at least ``MIN_COUNT`` times is
retained if its next-symbol distribution diverges from its suffix's by at
least ``DIVERGENCE`` nats, so the tree grows with the corpus. Distributions
are smoothed into their suffix's, from the root down; that gives every run the
chance of its last symbol behind the longest retained suffix of the others.
The driver does so for contexts up to ``LOW`` symbols (at most 256 ** LOW of
them); deeper contexts with the same last ``LOW + 1`` symbols meet in one task,
which takes such groups a few at a time.

A text's score is the sum over its runs. The most frequent runs (a fixed
number, of fixed size) are broadcast and all others meet their chances in a
shuffle join. The base score needs each token's training count: there, too,
the most frequent tokens (a fixed number, of bounded length) are broadcast and
all others meet their counts in a shuffle join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import SLICE_BYTES, held_out, materialize, text_slices

DEPTH, MIN_COUNT, DIVERGENCE = 6, 3, 0.02
#: Share of all training symbols that a context needs besides; 0 keeps the least count the same at every size.
MIN_SHARE = 0.0
#: Weight of the suffix's distribution, in observations; pseudo-count of a symbol at the root.
BACK_OFF, ROOT = 4.0, 0.5
BLANK, END = 0x20, 0x0A
#: Broadcast bound of the known tokens; distinct items a task holds before it passes counts on.
HOT_TOKENS, HOT_BYTES, FLUSH = 400_000, 64, 400_000
GRAMS_HELD, ROWS = 1_000_000, 100_000
#: Broadcast bound of the known runs, of 16 bytes each.
HOT_GRAMS = 2_000_000
#: Context symbols the driver resolves; runs a task resolves at a time.
LOW, TOGETHER = 2, 300_000
#: Symbols of a stretch that is scored in one go.
STRETCH = 512
COUNTS = pa.schema([("token", pa.string()), ("gram", pa.int64()), ("n", pa.int64()), ("used", pa.int64())])
PARTS = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("token", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
#: The end token among the words, which never hold white space.
END_TOKEN = "\n"


def tokens(text: bytes) -> list[bytes]:
    """Words of a text: runs without ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def symbols(words: list[bytes]) -> bytes:
    return b" ".join(words) + b"\n"


def pack_grams(data: np.ndarray, width: int) -> np.ndarray:
    """Each run of ``width`` symbols as one integer, the last symbol lowest."""
    n = len(data) - width + 1
    key = np.zeros(n, np.int64)
    for k in range(width):
        key = (key << 8) | data[k : k + n]
    return key


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    keys, n = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(keys)
    keys = keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], np.add.reduceat(n[order], start)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the training texts; runs of all texts, with their number in training texts and in all."""
    words: Counter = Counter()
    found: list[tuple[np.ndarray, np.ndarray]] = []  # twice the run, and 1 where it is held out

    def word_rows() -> pa.RecordBatch:
        n = pa.array(words.values(), pa.int64())
        return pa.record_batch([pa.array([w.decode() for w in words], pa.string()), pa.nulls(len(words), pa.int64()), n, n], schema=COUNTS)

    def gram_rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(keys), ROWS):
            gram, used = keys[a : a + ROWS] >> 1, n[a : a + ROWS]
            yield pa.record_batch([pa.nulls(len(gram), pa.string()), pa.array(gram), pa.array(used * (1 - (keys[a : a + ROWS] & 1))), pa.array(used)], schema=COUNTS)

    for batch in batches:
        for a, b in text_slices(batch, "text", SLICE_BYTES // 2):
            parts = []
            train = ~batch.column("held_out")[a:b].to_numpy(zero_copy_only=False)
            for text, learned in zip(batch.column("text")[a:b].cast(pa.binary()).to_pylist(), train.tolist(), strict=True):
                got = tokens(text)
                if learned:
                    words.update(got)
                parts.append(symbols(got))
            if train.any():
                words[END_TOKEN.encode()] += int(train.sum())
            grams, size = text_grams(parts)
            found.append(np.unique(grams << 1 | np.repeat(~train, size), return_counts=True))
            if sum(len(f[0]) for f in found) > GRAMS_HELD:
                found = [_merged(found)]
                if len(found[0][0]) > GRAMS_HELD // 2:
                    yield from gram_rows(*found.pop())
            if len(words) > FLUSH:
                yield word_rows()
                words = Counter()
    if words:
        yield word_rows()
    if found:
        yield from gram_rows(*_merged(found))


def text_grams(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The run that ends at each symbol of the texts, text after text, and the texts' sizes."""
    size = [len(p) for p in parts]
    # every text starts behind an end symbol, the first of the slice too
    data = np.frombuffer(b"\n" * DEPTH + (b"\n" * (DEPTH - 1)).join(parts), np.uint8)
    return pack_grams(data, DEPTH + 1)[_text_places(size)], np.array(size)


def _text_places(sizes: list[int]) -> np.ndarray:
    """Places of the texts' own symbols where DEPTH - 1 ends stand between texts."""
    size = np.array(sizes)
    start = np.cumsum(size + DEPTH - 1) - (size + DEPTH - 1)
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def chances_of(keys: np.ndarray, n: np.ndarray, least: int, low: int, depth: int, under=None) -> tuple[np.ndarray, np.ndarray]:
    """Per run of ``depth + 1`` symbols (sorted, distinct): its share of its context's counts, and its chance.

    Depths from ``low`` on are resolved, below them ``under`` is asked for
    both figures of the runs one symbol shorter. Contexts under the least count or DIVERGENCE
    (Kullback-Leibler divergence from the suffix) pass their suffix's chance on.
    """
    if depth == 0:
        whole = n.sum()
        return n / max(whole, 1), (n + ROOT) / (whole + 256 * ROOT)
    short = keys & ((1 << 8 * depth) - 1)
    if depth == low and under is not None:
        q, back = under(short)
    else:
        up, place = np.unique(short, return_inverse=True)
        q, back = (x[place] for x in chances_of(up, np.bincount(place, n, len(up)).astype(np.int64), least, low, depth - 1, under))
    context = keys >> 8
    start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    size = np.diff(np.append(start, len(keys)))
    total = np.add.reduceat(n, start)
    share = n / np.repeat(np.maximum(total, 1), size)
    told = np.zeros(len(n))
    some = n > 0
    told[some] = share[some] * np.log(share[some] / q[some])
    kept = np.repeat((total >= least) & (np.add.reduceat(told, start) >= DIVERGENCE), size)
    return share, np.where(kept, (n + BACK_OFF * back) / (np.repeat(total, size) + BACK_OFF), back)


def _resolver(shared):
    """Runs sorted by the last LOW + 1 symbols of their context, those with the same all in one task, to their chances."""

    def resolve(keys: np.ndarray, n: np.ndarray, used: np.ndarray) -> pa.RecordBatch:
        least, low, share, chance = shared.value

        def under(short):
            at = np.searchsorted(low, short)
            return share[at], chance[at]

        order = np.argsort(keys)
        _, p = chances_of(keys[order], n[order], least, LOW + 1, DEPTH, under)
        return pa.record_batch([pa.array(keys[order]), pa.array(used[order]), pa.array(np.log10(p))], names=["gram", "used", "log"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in ("gram", "n", "used")])
            if sum(len(h[0]) for h in held) >= TOGETHER:
                keys, n, used = (np.concatenate(x) for x in zip(*held, strict=True))
                group = keys >> 8 & (1 << 8 * (LOW + 1)) - 1
                whole = int(np.flatnonzero(group != group[-1])[-1]) + 1 if (group != group[-1]).any() else 0
                if whole:
                    yield resolve(keys[:whole], n[:whole], used[:whole])
                held = [[keys[whole:], n[whole:], used[whole:]]]
        if held and sum(len(h[0]) for h in held):
            yield resolve(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def gram_chances(grams: DataFrame) -> DataFrame:
    """(gram, used, log) of every run: log10 chance of its last symbol behind the others.

    ``grams`` has distinct (gram, n, used), n being the training count.
    """
    short = F.col("gram").bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1))
    rows = grams.groupBy(short.alias("gram")).agg(F.sum("n").alias("n")).toArrow()  # at most 256 ** (LOW + 1)
    order = np.argsort(rows["gram"].to_numpy())
    low, n = rows["gram"].to_numpy()[order], rows["n"].to_numpy()[order]
    least = max(MIN_COUNT, math.ceil(MIN_SHARE * int(n.sum())))
    shared = grams.sparkSession.sparkContext.broadcast((least, low, *(chances_of(low, n, least, 1, LOW) if len(low) else (n, n))))
    group = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1))
    rows = grams.withColumn("group", group).repartition("group").sortWithinPartitions("group").select("gram", "n", "used")
    return materialize(rows.mapInArrow(_resolver(shared), "gram long, used long, log double"), "lm-chances")


def hot_grams(chances: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs, ``most`` at most, and their log10 chances: all runs above a frequency."""
    step = F.floor(F.log2("used") * 8)
    total, least = 0, None
    for r in sorted(chances.groupBy(step.alias("step")).count().collect(), reverse=True):  # at most 8 * 63 rows
        total += r["count"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    top = chances.filter(step >= least).select("gram", "log").toArrow()
    order = np.argsort(top["gram"].to_numpy())
    return top["gram"].to_numpy()[order], top["log"].to_numpy()[order]


class SuffixTree:
    """Automaton of given contexts: next state and log10 probability tables.

    For a small set of contexts in memory; score_documents works on tables.
    """

    def __init__(self, rows: pa.Table):
        entries: dict[bytes, dict[int, int]] = {b"": {}}
        for d, c, x, n in zip(*(rows[k].to_pylist() for k in ("depth", "context", "next", "n")), strict=True):
            entries.setdefault(c.to_bytes(d, "big"), {})[x] = n
        # symbols never seen in training have one common probability in every context
        seen = sorted({x for e in entries.values() for x in e} | {BLANK, END})
        self.code = np.full(256, len(seen), np.int32)
        self.code[seen] = np.arange(len(seen))
        self.width = len(seen) + (len(seen) < 256)
        spread = np.ones(self.width)
        if len(seen) < 256:
            spread[-1] = 256 - len(seen)
        chance: dict[bytes, np.ndarray] = {}
        for context in sorted(entries, key=len):
            n = np.zeros(self.width)
            for x, v in entries[context].items():
                n[self.code[x]] = v
            if context:
                back = chance[self._longest(context[1:], chance)]
                chance[context] = (n + BACK_OFF * back) / (n.sum() + BACK_OFF)
            else:
                chance[context] = (n + ROOT * spread) / (n.sum() + ROOT * 256)
        states = sorted({c[:k] for c in entries for k in range(len(c) + 1)}, key=lambda c: (len(c), c))
        place = {c: i for i, c in enumerate(states)}
        self.move = np.zeros((len(states), self.width), np.int32)
        self.log = np.zeros((len(states), self.width), np.float32)
        for i, state in enumerate(states):
            if state:
                self.move[i] = self.move[place[self._longest(state[1:], place)]]
            self.log[i] = np.log10(chance[self._longest(state, chance)] / spread)
            for x in seen:
                j = place.get(state + bytes([x]))
                if j is not None:
                    self.move[i, self.code[x]] = j
        self.move *= self.width  # states as row starts of the flat tables
        self.move, self.log = self.move.ravel(), self.log.ravel()
        self.start = 0
        for _ in range(DEPTH):
            self.start = int(self.move[self.start + self.code[END]])

    @staticmethod
    def _longest(context: bytes, among: dict) -> bytes:
        while context not in among:
            context = context[1:]
        return context

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each symbol string (each starts behind an end symbol)."""
        total = np.zeros(len(texts))
        size = np.array([len(t) for t in texts])
        many = -(-size // STRETCH)
        owner = np.repeat(np.arange(len(texts)), many)
        at = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * STRETCH
        data = np.frombuffer(b"\n" * DEPTH + b"".join(texts), np.uint8)
        codes = self.code[data]
        begin = np.repeat(np.cumsum(size) - size, many) + at + DEPTH
        left = np.minimum(size[owner] - at, STRETCH)
        order = np.argsort(-left, kind="stable")  # so that the stretches still running stand in front
        owner, begin, left, first = owner[order], begin[order], left[order], at[order] == 0
        # the state before a stretch follows from the DEPTH symbols in front of it
        state = np.where(first, self.start, 0)
        for k in range(DEPTH, 0, -1):
            state = np.where(first, state, self.move[state + codes[begin - k]])
        running = np.searchsorted(-left, -np.arange(STRETCH), "left")
        value = np.zeros(len(owner))
        for k in range(int(left.max(initial=0))):
            n = running[k]
            cell = state[:n] + codes[begin[:n] + k]
            value[:n] += self.log[cell]
            state[:n] = self.move[cell]
        np.add.at(total, owner, value)
        return total


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, logs, known, end, all_tokens, distinct = shared.value
        count = known.get
        whole = math.log10(all_tokens + 0.5 * (distinct + 1))
        for batch in batches:
            for a, b in text_slices(batch, "text", SLICE_BYTES // 2):
                part = batch.slice(a, b - a)
                rids = part.column("rid").to_pylist()
                words = [tokens(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                grams, size = text_grams([symbols(w) for w in words])
                own, place = np.unique(grams, return_inverse=True)
                at = np.searchsorted(hot, own)
                at[at == len(hot)] = 0
                hit = hot[at] == own if len(hot) else np.zeros(len(own), bool)
                value = np.where(hit, logs[at], 0.0) if len(hot) else np.zeros(len(own))
                scores = np.add.reduceat(value[place], np.cumsum(size) - size)
                cold = np.flatnonzero(~hit[place])
                pair, pair_n = np.unique(np.repeat(np.arange(len(size)), size)[cold] * len(own) + place[cold], return_counts=True)
                n_known, base, rare_rid, rare_token, rare_n = [], [], [], [], []
                for rid, got in zip(rids, words, strict=True):
                    c = np.array([*map(count, got, repeat(0))] + [end], np.float64)
                    rare = np.flatnonzero(c[:-1] == 0)
                    if len(rare):
                        for w, n in Counter([got[i] for i in rare.tolist()]).items():
                            rare_rid.append(rid)
                            rare_token.append(w.decode())
                            rare_n.append(n)
                        c = np.delete(c, rare)
                    n_known.append(int((c > 0).sum()))
                    base.append(float((np.log10(c + 0.5) - whole).sum()))
                none = pa.nulls(len(rids), pa.string())
                yield pa.record_batch([part.column("rid"), part.column("doc_id"), part.column("held_out"), pa.array([len(w) + 1 for w in words], pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(scores), none, pa.nulls(len(rids), pa.int64()), pa.nulls(len(rids), pa.int64())], schema=PARTS)
                if rare_rid:
                    empty = [pa.nulls(len(rare_rid), f.type) for f in list(PARTS)[1:7]]
                    yield pa.record_batch([pa.array(rare_rid, pa.int64()), *empty, pa.array(rare_token, pa.string()), pa.nulls(len(rare_rid), pa.int64()), pa.array(rare_n, pa.int64())], schema=PARTS)
                for k in range(0, len(pair), ROWS):
                    some = pair[k : k + ROWS]
                    empty = [pa.nulls(len(some), f.type) for f in list(PARTS)[1:8]]
                    yield pa.record_batch([pa.array(np.array(rids, np.int64)[some // len(own)]), *empty, pa.array(own[some % len(own)]), pa.array(pair_n[k : k + ROWS])], schema=PARTS)

    return run


def score_documents(docs: DataFrame, modulus: int = 5, hot: int = HOT_TOKENS, hot_runs: int = HOT_GRAMS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Learns from the rows whose crc32(doc_id as text) mod ``modulus`` is not 1 and
    scores all rows. ``docs`` needs doc_id and text; other columns are ignored,
    whatever their names. A null or empty text is the end token alone. A null
    id is held out. Every input row gives one row, repeated rows included (a
    repeated training row counts each time); an empty table gives an empty
    table; without training rows every symbol is equally likely. Long texts are
    learned and scored whole.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", modulus).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.select("text", "held_out").mapInArrow(_counter, "token string, gram long, n long, used long")
    counts = materialize(counted.groupBy("token", "gram").agg(F.sum("n").alias("n"), F.sum("used").alias("used")), "lm-counts")
    words = counts.filter("token is not null").select("token", F.col("n").alias("c"))
    end = F.col("token") == END_TOKEN
    whole = words.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(end, F.col("c"))).alias("ends")).first()
    all_tokens, distinct, ends = whole["n"] or 0, whole["v"], whole["ends"] or 0
    chances = gram_chances(counts.filter("gram is not null").select("gram", "n", "used"))
    top = words.filter(F.octet_length("token") <= HOT_BYTES).orderBy(F.desc("c"), "token").limit(hot).toArrow()
    known = dict(zip([w.encode() for w in top["token"].to_pylist()], top["c"].to_pylist(), strict=True))
    shared = spark.sparkContext.broadcast((*hot_grams(chances, hot_runs), known, ends, all_tokens, distinct))
    named = rows.withColumn("rid", F.monotonically_increasing_id())
    kinds = "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, token string, gram long, n long"
    parts = materialize(named.mapInArrow(_scorer(shared), kinds), "lm-parts")
    heads = parts.filter("token is null and gram is null").drop("token", "gram", "n")
    rare = parts.filter("token is not null").select("rid", "token", "n").join(words, "token", "left")
    c = F.coalesce("c", F.lit(0))
    chance = F.log10(c + 0.5) - math.log10(all_tokens + 0.5 * (distinct + 1))
    rare = rare.select("rid", F.when(c > 0, F.col("n")).otherwise(0).alias("known"), (F.col("n") * chance).alias("base"))
    runs = parts.filter("gram is not null").select("rid", "gram", "n").join(chances, "gram").select("rid", (F.col("n") * F.col("log")).alias("score"))
    total = heads.unionByName(rare, allowMissingColumns=True).unionByName(runs, allowMissingColumns=True).groupBy("rid").agg(
        *(F.max(x).alias(x) for x in ("doc_id", "held_out", "n_tokens")), F.sum("score").alias("score"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"))
    return total.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(all_tokens).cast("long").alias("train_tokens"), "base_score", "score")
