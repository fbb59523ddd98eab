"""Spelling variants linked through k-d trees over letter counts (operator 11).

One inserted, deleted or replaced letter changes a word's letter counts by an
L1 distance of at most two: exactly two for another letter in its place, one
for a letter more or less. So near words are found by range searches with that
radius, in the words of the same length and in those one letter longer, and
the order of the letters decides.

Spark counts the words. A coarse tree per length, split on a bounded sample,
only says where a word lives: every cell of it is a group of Spark's shuffle,
and each word goes as a query to the cells whose box is within the radius. A
group becomes a k-d tree with tight boxes, and its queries stream past it. A
cell with more than ``GROUP`` words is dealt to parts, all of which its queries
visit, so no task holds more, whatever the sample missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import materialize

#: Words of a cell aimed at, most words of one tree, words of a leaf.
CELL, GROUP, LEAF = 4096, 16384, 8
#: Words the coarse trees are split on at most, and least sampled words of a cell.
SAMPLE, LEAST = 200_000, 32
#: Query words searched together, and (query, box) or (query, word) pairs compared at a time.
QUERIES, PAIRS = 4096, 200_000
RADIUS = 2
RUN = "[A-Za-zÀ-ÿ]+"
#: Letters a-z, then U+00C0 to U+00FF: the column of each Latin-1 byte.
DIMENSIONS = 26 + 64
COLUMN = np.zeros(256, np.int64)
COLUMN[ord("a") : ord("z") + 1] = np.arange(26)
COLUMN[0xC0:] = np.arange(26, DIMENSIONS)
#: Counts above this are held to it, which can only shorten a distance.
MOST = 250
LENGTH_STEP = 1_000_000


def letter_counts(words: list[bytes]) -> np.ndarray:
    """One row of letter counts for each Latin-1 word."""
    flat = COLUMN[np.frombuffer(b"".join(words), np.uint8)]
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(row * DIMENSIONS + flat, minlength=len(words) * DIMENSIONS)
    return np.minimum(counts, MOST).astype(np.uint8).reshape(len(words), DIMENSIONS)


class Tree:
    """A k-d tree: each node has a box (lowest and highest counts), inner nodes two children.

    ``order`` lists the points leaf by leaf; a leaf owns ``order[start:end]``.
    With ``tight`` boxes enclose the points, else the half spaces of the splits.
    """

    def __init__(self, points: np.ndarray, leaf: int, tight: bool):
        self.order = np.arange(len(points))
        low, high, child, span = [], [], [], []

        def add(lo: np.ndarray, hi: np.ndarray, start: int, end: int) -> int:
            low.append(lo)
            high.append(hi)
            child.append((-1, -1))
            span.append((start, end))
            return len(span) - 1

        def box(start: int, end: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not tight:
                return lo, hi
            mine = points[self.order[start:end]]
            return mine.min(0), mine.max(0)

        everything = (np.zeros(DIMENSIONS, np.uint8), np.full(DIMENSIONS, 255, np.uint8))
        open_ = [add(*(box(0, len(points), *everything) if len(points) else everything), 0, len(points))]
        while open_:
            node = open_.pop()
            start, end = span[node]
            if end - start <= leaf:
                continue
            ids = self.order[start:end]
            mine = points[ids]
            column = int(mine.var(0).argmax())
            values = mine[:, column]
            if values.min() == values.max():
                continue  # all alike
            cut = np.sort(values)[(len(values) - 1) // 2]
            if cut == values.max():
                cut = values[values < cut].max()
            left = values <= cut
            middle = start + int(left.sum())
            self.order[start:end] = np.concatenate([ids[left], ids[~left]])
            below, above = high[node].copy(), low[node].copy()
            below[column], above[column] = cut, cut + 1
            pair = add(*box(start, middle, low[node], below), start, middle), add(*box(middle, end, above, high[node]), middle, end)
            child[node] = pair
            open_ += pair
        self.low, self.high = np.array(low), np.array(high)
        self.child, self.span = np.array(child), np.array(span)
        self.leaf_number = np.cumsum(self.child[:, 0] < 0) - 1

    def near_leaves(self, x: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of x, leaf node) pairs whose box is within the radius."""
        work = [(np.arange(len(x)), np.zeros(len(x), np.int64))]
        while work:
            row, node = work.pop()
            if len(row) > PAIRS:
                half = len(row) // 2
                work += [(row[:half], node[:half]), (row[half:], node[half:])]
                continue
            at, lo, hi = x[row], self.low[node], self.high[node]
            away = (np.where(lo > at, lo - at, 0) + np.where(at > hi, at - hi, 0)).sum(1, dtype=np.int32)
            row, node = row[away <= radius], node[away <= radius]
            end = self.child[node, 0] < 0
            if end.any():
                yield row[end], node[end]
            row, node = row[~end], node[~end]
            if len(row):
                work.append((np.repeat(row, 2), self.child[node].ravel()))

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf number of each point (trees without tight boxes)."""
        out = np.zeros(len(x), np.int64)
        for row, node in self.near_leaves(x, 0):
            out[row] = self.leaf_number[node]
        return out


def _matrix(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` and ``b`` (as long, or one letter longer) differ by one edit."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= length


class WordGroup:
    """The words of one cell as a tree, searched by words as long or one letter shorter."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.length = len(words[0])
        self.points = letter_counts(words)
        self.letters = _matrix(words, self.length)
        self.tree = Tree(self.points, LEAF, tight=True)

    def near(self, queries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs that differ by one edit; all queries have one length."""
        x, letters = letter_counts(queries), _matrix(queries, len(queries[0]))
        radius = RADIUS if len(queries[0]) == self.length else 1
        asked, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row, node in self.tree.near_leaves(x, radius):
            size = self.tree.span[node, 1] - self.tree.span[node, 0]
            for some in _slices(size):
                many = size[some]
                q = np.repeat(row[some], many)
                first = np.repeat(self.tree.span[node[some], 0] - np.cumsum(many) + many, many)
                p = self.tree.order[first + np.arange(many.sum())]
                at, to = x[q], self.points[p]
                close = np.where(at > to, at - to, to - at).sum(1, dtype=np.int32) <= radius
                q, p = q[close], p[close]
                right = one_edit(letters[q], self.letters[p])
                asked.append(q[right])
                found.append(p[right])
        return np.concatenate(asked), np.concatenate(found)


def _slices(size: np.ndarray) -> Iterator[slice]:
    """Runs of rows whose sizes add up to about PAIRS (one row at least)."""
    total = np.cumsum(size)
    start = 0
    while start < len(size):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, "right")))
        yield slice(start, end)
        start = end


def coarse_trees(sample: list[str], rate: float) -> dict[int, Tree]:
    """One tree per word length, with leaves of about CELL words at this sampling rate."""
    by_length: dict[int, list[bytes]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word.encode("latin-1"))
    leaf = max(LEAST, int(CELL * rate))
    return {n: Tree(letter_counts(words), leaf, tight=False) for n, words in by_length.items()}


ROUTED = "cell long, home boolean, word string, n long"


def _router(trees: dict[int, Tree]):
    """Each word at its own cell (home) and as a query at the cells within its reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            lengths = np.array([len(w) for w in words])
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                for a in range(0, len(rows), QUERIES):
                    some = rows[a : a + QUERIES]
                    x = letter_counts([words[i] for i in some])
                    own = trees[length].home(x) if length in trees else np.zeros(len(some), np.int64)
                    cell, row, home = [length * LENGTH_STEP + own], [some], [np.ones(len(some), bool)]
                    for other, radius in ((length, RADIUS), (length + 1, 1)):
                        tree = trees.get(other)
                        hits = tree.near_leaves(x, radius) if tree else [(np.arange(len(some)), None)]
                        for r, node in hits:
                            leaf = tree.leaf_number[node] if tree else np.zeros(len(r), np.int64)
                            away = (leaf != own[r]) | (other != length)
                            cell.append(other * LENGTH_STEP + leaf[away])
                            row.append(some[r[away]])
                            home.append(np.zeros(away.sum(), bool))
                    taken = batch.select(["word", "n"]).take(pa.array(np.concatenate(row)))
                    yield pa.record_batch([pa.array(np.concatenate(cell)), pa.array(np.concatenate(home)), taken.column("word"), taken.column("n")], names=["cell", "home", "word", "n"])

    return run


FOUND = "word string, n_near long, other_n long, other string"


def _links(group: WordGroup, words: pa.Array, n: np.ndarray, queries: pa.Array, qn: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per word, how many near words a batch of queries of one length shows, and the greatest of them."""
    asked, found = group.near([w.encode("latin-1") for w in queries.to_pylist()])
    if not len(asked):
        return
    # words of one length ask each other; a longer word learns of the shorter one here
    sides = [(asked, queries, found, words, n)]
    if len(queries[0].as_py()) != group.length:
        sides.append((found, words, asked, queries, qn))
    for who, names, whom, others, weight in sides:
        text = np.array(others.to_pylist(), object)
        order = np.lexsort((text[whom].astype(str), -weight[whom], who))
        who, whom = who[order], whom[order]
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        count = np.diff(np.r_[first, len(who)])
        yield pa.record_batch([names.take(pa.array(who[first])), pa.array(count), pa.array(weight[whom[first]]), others.take(pa.array(whom[first]))], names=["word", "n_near", "other_n", "other"])


def _searcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, part, home first, length): the home rows become a tree, the others pass it."""
    key, held, group = None, [], None  # of the group at hand: its home words so far, then its tree

    def search(some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(w) for w in some.column("word").to_pylist()])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            for a in range(0, len(rows), QUERIES):
                part = some.take(pa.array(rows[a : a + QUERIES]))
                yield from _links(group, members.column("word"), members_n, part.column("word"), part.column("n").to_numpy())

    def build() -> None:
        nonlocal group, members, members_n
        members = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        members_n = members.column("n").to_numpy()
        group = WordGroup([w.encode("latin-1") for w in members.column("word").to_pylist()])

    members, members_n = None, None
    for batch in batches:
        cell, part, home = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "part", "home"))
        new = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (home[1:] != home[:-1])])
        for start, end in zip(new, np.r_[new[1:], len(cell)], strict=True):
            some = batch.slice(start, end - start).select(["word", "n"])
            if (cell[start], part[start]) != key:
                if held and group is None:
                    build()
                    yield from search(members)
                key, held, group = (cell[start], part[start]), [], None
            if home[start]:
                held.append(some)
                continue
            if not held:
                continue  # a cell without words
            if group is None:
                build()
                yield from search(members)
            yield from search(some)
    if held and group is None:
        build()
        yield from search(members)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): near words of each word that has one, and the most frequent of them.

    ``words`` holds distinct ``word`` (letters of RUN, not empty) and ``n``.
    """
    total = words.count()
    rate = min(1.0, SAMPLE / max(total, 1))
    drawn = words if rate == 1.0 else words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    trees = coarse_trees([r.word for r in drawn.select("word").collect()], rate)
    routed = materialize(words.repartition("word").mapInArrow(_router(trees), ROUTED), "spelling-cells")
    parts = routed.filter("home").groupBy("cell").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts")).filter("parts > 1")
    dealt = routed.join(parts, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    whole = dealt.filter("parts = 1").select("cell", F.lit(0).alias("part"), "home", "word", "n")
    # a home word of a cell in parts stays in one and asks the others
    split = dealt.filter("parts > 1").select("cell", F.explode(every).alias("part"), "home", "word", "n", mine.alias("mine"))
    split = split.select("cell", "part", (F.col("home") & (F.col("part") == F.col("mine"))).alias("home"), "word", "n")
    together = whole.unionByName(split).repartition("cell", "part").sortWithinPartitions("cell", "part", F.desc("home"))
    found = together.mapInArrow(_searcher, FOUND)
    best = F.min(F.struct((-F.col("other_n")).alias("n"), "other"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.other").alias("best"))


def _lower(run: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, letters, letters.lower()))


def word_counts(docs: DataFrame, every: int = 199, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n) of the letter runs of all texts; one run in ``every`` loses a letter, as typing errors do."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length).withColumn("run", _lower(F.col("run")))
    h, size = F.crc32(F.concat("doc", F.lit(":"), "run")), F.length("run")
    place = (F.col("h") % size).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, size))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    kept = runs.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= least_length)
    return kept.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct ``words`` (word, n).

    ``form`` is the near word of largest n (ties: smallest in code-point order)
    if it is at least ``times`` as frequent, else null; ``root`` is the end of
    the forms, the word itself without one. A form is more frequent than its
    word, so there are no circles. An empty table gives an empty table.
    """
    near = near_words(words)
    form = F.when(F.col("best_n") >= times * F.col("n"), F.col("best"))
    formed = words.join(near, "word", "left").select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n"))
    formed = materialize(formed, "spelling-forms")
    ends = formed.filter("form is not null").select("word", F.col("form").alias("to"))
    while True:  # each round doubles the way that is known; n grows times-fold a step, so few rounds do
        ends = materialize(ends, "spelling-ends")
        onward = ends.toDF("to", "next")
        step = ends.join(onward, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        step = materialize(step, "spelling-steps")
        ends = step.select("word", "to")
        if step.filter("moved").isEmpty():
            break
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, every: int = 199, least_length: int = 6, least_count: int = 5, times: int = 5) -> DataFrame:
    """Spelling variants among the words of ``docs``: word, form, root, n, n_near, form_n.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in
    lower case; null, empty and letterless texts have none, a null id counts as
    an empty one, repeated rows count each, and texts and words of any length are
    read whole. Words of fewer than ``least_length`` letters or ``least_count``
    occurrences take no part. See ``variants`` for the columns.
    """
    return variants(materialize(word_counts(docs, every, least_length, least_count), "spelling-words"), times)
