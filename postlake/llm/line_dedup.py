"""Line deduplication by an exact set-similarity join (operator 4), native Spark only.

A line is the set of its words. Lines whose sets have a Jaccard similarity of
at least ``percent`` match, and a line that matches an earlier one (order of
doc_id, then line number) is removed.

Documents are numbered in the order of their ids, so that one number, the place,
stands for a line and for its order. Equal sets are folded first to the one of
the earliest place, so a line that stands in a third of all documents is one
set, and that place is its id. Each set's words are ordered by rarity, and a
sign of a set is a word with the one after it: two words that are rare and have
none of the set between them. A match keeps most signs, so it shares one of the
first 2 (1 - t) n + 1, and only these are posted. The postings are shuffled by
sign, once, and in ``SLICES`` parts one after the other, each of all signs of
its words, so that only one part's shuffle files stand on disk at a time; those
of one set alone end there. Pairs that share a sign and pass the length and
bitmap filters fetch their lines, and the Jaccard similarity is verified on the
words themselves. Single words pair far more sets than match, and ever more as
the corpus grows; two words seldom do.

Any common word order keeps prefix filtering exact; rarity only makes it
selective. It comes from the counts of ``RARITY_BUCKETS`` hashed words over all
texts, a table of fixed size that stands beside each document. A posting also
carries the parity bitmap of its set: each word flips one of 64 bits, so two
sets differ in at least as many words as their bitmaps differ in bits, and a
pair that would differ in too many is dropped. Within a line, words are told
apart by 56 bits of their hashes and the rarity; across lines hashes only
propose pairs and words decide.

Arrays are exploded with the outer form: for the inner one Spark works out the
array once more, to filter on its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import discard, materialize

#: As many groups as Spark's aggregation holds in its fast map.
RARITY_BUCKETS = 1 << 16
#: Parts in which the postings are shuffled, one after the other.
SLICES = 2
#: Bits of a place for the line; a document of more lines would not fit an array.
LINE_BITS = 28
#: Rows up to which a side is broadcast after it was counted; else it is shuffled.
BROADCAST_ROWS = 1_000_000
#: ASCII white space other than blank and line feed.
OTHER_SPACE = r"[\x09\x0B-\x0D]"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _free_shuffles(df: DataFrame) -> None:
    """Ask the driver for a garbage collection: Spark deletes the shuffle files of finished queries with it."""
    df.sparkSession._jvm.System.gc()


def words_of(line: Column) -> Column:
    """Distinct lower-case words of a line whose only white space is blanks."""
    return F.array_remove(F.array_distinct(F.split(F.lower(line), " ")), "")


def _blanks(text: Column) -> Column:
    """The text with blanks for other ASCII white space, line feeds apart."""
    other = reduce(Column.__or__, (F.contains(text, F.lit(c)) for c in "\t\x0b\x0c\r"))  # far cheaper than a pattern
    return F.when(other, F.regexp_replace(text, OTHER_SPACE, " ")).otherwise(text)


def _texts(docs: DataFrame) -> DataFrame:
    """(doc, row, text): order of the id with null ids last, a key of id and text, the text."""
    text = F.coalesce("text", F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc, F.lit(2**63 - 1)).alias("doc"), F.xxhash64(doc, text).alias("row"), text.alias("text"))


def _bucket(word_hash: Column) -> Column:
    return word_hash.bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int")


def _bit(number: Column) -> Column:
    """One of 64 bits of a word's number, from hash bits above those of the bucket."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(number, 50).cast("int"))  # a shift takes the last 6 bits


def _rarity(texts: DataFrame) -> DataFrame:
    """One row: for each bucket its word count in quarters of a doubling (RARITY_BUCKETS bytes)."""
    words = texts.select(F.explode_outer(F.split(F.replace(F.lower(_blanks(F.col("text"))), F.lit("\n"), F.lit(" ")), " ")).alias("word"))
    counts = words.groupBy(_bucket(F.xxhash64("word")).alias("bucket")).agg(F.count("*").alias("n"))
    every = texts.sparkSession.range(RARITY_BUCKETS).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("n"))
    full = every.unionByName(counts).groupBy("bucket").agg(F.sum("n").alias("n"))
    level = F.least(F.floor(4 * F.log2(F.col("n") + 1)), F.lit(127)).cast("byte")
    ordered = F.array_sort(F.collect_list(F.struct("bucket", level.alias("level"))))  # RARITY_BUCKETS rows
    return full.agg(F.transform(ordered, lambda x: x["level"]).alias("rarity"))


def _sets(texts: DataFrame, rarity: DataFrame) -> DataFrame:
    """(doc, row, line, n, parity, w) of each line with words: w orders the words by rarity.

    A word becomes one number, the level of its bucket above its hash. Words are
    numbered inside their document's row, so that the rarity table stands beside
    each document and not beside each line; the rest is done line by line.
    """
    def number(h: Column) -> Column:
        level = F.coalesce(F.get("rarity", _bucket(h)), F.lit(0).cast("byte")).cast("long")
        return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    with_table = texts.select("doc", "row", F.lower(_blanks(F.col("text"))).alias("text"), rarity.scalar().alias("rarity"))
    numbers = F.transform(F.split("text", "\n"), lambda line: F.transform(F.split(line, " "), lambda w: number(F.xxhash64(w))))
    per_line = with_table.select("doc", "row", number(F.xxhash64(F.lit(""))).alias("none"), numbers.alias("sets"))
    lines = per_line.select("doc", "row", "none", F.posexplode_outer("sets").alias("line", "w"))
    lines = lines.select("doc", "row", "line", F.sort_array(F.array_remove(F.array_distinct("w"), F.col("none"))).alias("w")).filter(F.size("w") > 0)
    parity = F.aggregate("w", F.lit(0).cast("long"), lambda bits, v: bits.bitwiseXOR(_bit(v)))
    return lines.select("doc", "row", "line", F.size("w").alias("n"), parity.alias("parity"), "w")


def _numbered(keyed: DataFrame) -> DataFrame:
    """(doc, row, num) of the documents with lines: numbers from 0 without a gap, in the order of doc and row."""
    keys = keyed.select("doc", "row").distinct()
    ranged = keys.repartitionByRange("doc", "row").sortWithinPartitions("doc", "row").withColumn("at", F.monotonically_increasing_id())
    ranged = materialize(ranged, "line-ranges")  # the id is 33 bits of a row's number below that of its partition
    part = F.shiftrightunsigned("at", 33)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    num = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = materialize(ranged.withColumn("part", part).join(F.broadcast(starts), "part").select("doc", "row", num.alias("num")), "line-docs")
    discard(ranged)
    return numbered


def _signs(percent: int) -> Column:
    """How many signs of a set of n words there are, one of which any match shares; none where no other set can match.

    Above 50 percent a sign is a word with the one after it. A word that a match
    lacks takes two signs with it, and one that a match adds takes one, so at
    most 2 (1 - t) n are lost. Up to 50 percent a sign is a single word.
    """
    lost = F.floor((2 if percent > 50 else 1) * (100 - percent) * F.col("n") / F.lit(100)).cast("int")
    return F.when(100 * F.col("n") >= percent * (F.col("n") + 1), lost + 1).otherwise(0)


def _postings(sets: DataFrame, percent: int, part: int) -> DataFrame:
    """(sign, id, n, parity) for the signs of the sets whose first words are of the part; narrow, for it is shuffled."""
    k = _signs(percent)
    words = F.arrays_zip(F.slice("prefix", F.lit(1), k).alias("v"), F.slice("prefix", F.lit(2), k).alias("after"))
    each = sets.filter(F.size("prefix") > 0).select(F.explode_outer(words).alias("s"), "id", "n", "parity").filter(F.pmod("s.v", F.lit(SLICES)) == part)
    sign = F.xxhash64("s.v", "s.after") if percent > 50 else F.xxhash64("s.v")
    return each.select(sign.alias("sign"), "id", "n", "parity")


def _shared(postings: DataFrame, percent: int) -> DataFrame:
    """Postings of signs that earlier sets have, each with the earliest of them (x).

    near: the two may match; many: the sign has three sets or more. Postings that are neither go.
    """
    sign = Window.partitionBy("sign").orderBy("id")
    first = (F.first(c).over(sign).alias(f"x{c}") for c in ("id", "n", "parity"))
    met = postings.select("*", *first, (F.lead("id").over(sign).isNotNull() | (F.row_number().over(sign) > 2)).alias("many"), F.lag("id").over(sign).alias("last"))
    met = met.filter("xid < id and last < id")  # rows that repeat an id and text post one place
    near = _possible("xn", "n", "xparity", "parity", percent)
    return met.select("sign", "id", "n", "parity", F.col("xid").alias("x"), near.alias("near"), "many").filter("near or many")


def _possible(n: str, m: str, a: str, b: str, percent: int) -> Column:
    """Length and bitmap filters of sets of n and m words with parity bitmaps a and b."""
    length = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return length & ((100 + percent) * F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= (100 - percent) * (F.col(n) + F.col(m)))


def _place(num: Column, line: Column) -> Column:
    return F.shiftleft(num, LINE_BITS).bitwiseOR(line.cast("long"))


def matching_sets(texts: DataFrame, docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (x, y) whose words have the similarity.

    The wanted lines of a document are taken from one split of its text.
    """
    wanted = pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id"))).distinct()
    line = F.col("id").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int").alias("line")
    where = wanted.groupBy(F.shiftright("id", LINE_BITS).alias("num")).agg(F.collect_list(F.struct(line, "id")).alias("wanted"))  # lines of one document
    where = materialize(where.join(docs, "num").select("doc", "row", "wanted"), "line-wanted")
    some = texts.join(_small(where, where.count()), ["doc", "row"]).select("wanted", F.split("text", "\n").alias("lines"))
    line = F.transform("wanted", lambda x: F.struct(x["id"].alias("id"), F.get("lines", x["line"]).alias("line")))
    found = some.select(F.explode_outer(line).alias("s")).select("s.id", F.array_join(words_of(_blanks(F.col("s.line"))), " ").alias("words")).dropDuplicates(["id"])
    x, y = found.toDF("x", "xw").hint("shuffle_hash"), found.toDF("y", "yw").hint("shuffle_hash")
    # words travel as one string: an array of strings takes several times the bytes
    both = pairs.join(x, "x").join(y, "y").select("x", "y", F.split("xw", " ").alias("xw"), F.split("yw", " ").alias("yw"))
    shared = F.size(F.array_intersect("xw", "yw"))
    alike = both.filter((100 + percent) * shared >= percent * (F.size("xw") + F.size("yw"))).select("x", "y")
    alike = materialize(alike, "line-alike")
    discard(where)
    return alike


def repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc, row, lines) of documents that lose lines: the numbers of the lines to remove.

    ``doc`` is the id (null: the largest long) and ``row`` a hash of id and text,
    the key under which ``drop_lines`` finds the document again.
    """
    texts = _texts(docs)
    rarity = materialize(_rarity(texts), "line-rarity")
    keyed = _sets(texts, rarity)
    signs = _signs(percent)  # and the word after the last of them
    prefix = F.transform(F.slice("w", F.lit(1), F.when(signs > 0, signs + 1).otherwise(0)), lambda v: F.hash(v))
    keyed = keyed.select("doc", "row", "line", "n", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), F.col("w")).alias("h2"), "parity", prefix.alias("prefix"))
    keyed = materialize(keyed, "line-sets")

    numbered = _numbered(keyed)
    placed = keyed.join(_small(numbered, numbered.count()), ["doc", "row"]).withColumn("id", _place(F.col("num"), F.col("line")))
    lines = materialize(placed.select("id", "h1", "h2"), "line-places")
    folded = materialize(lines.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("count")), "line-firsts")
    posted = placed.filter(F.size("prefix") > 0).select("id", "n", "parity", "prefix")
    sets = materialize(posted.join(folded.select("id").hint("shuffle_hash"), "id", "left_semi"), "line-prefixes")
    discard(rarity, keyed)
    # Any earlier match decides, so each set first meets only the earliest set of each
    # of its signs: pairs in proportion to the postings, which settle groups of near
    # copies. Only sets that this leaves open meet all earlier sets of their signs,
    # and only through signs of three sets or more: of two, the earliest is the other.
    parts = []
    for part in range(SLICES):
        _free_shuffles(texts)
        parts.append(materialize(_shared(_postings(sets, percent, part), percent), "line-postings"))
    discard(sets)
    _free_shuffles(texts)
    postings = reduce(DataFrame.unionByName, parts)
    pairs = materialize(postings.filter("near").select("x", F.col("id").alias("y")).distinct(), "line-pairs")
    settled = matching_sets(texts, numbered, pairs, percent)
    done = settled.select(F.col("y").alias("id")).distinct()
    many = postings.filter("many").select("sign", "id", "n", "parity")
    unsettled = many.join(_small(done, done.count()), "id", "left_anti").select("sign", F.col("id").alias("y"), F.col("n").alias("yn"), F.col("parity").alias("yparity"))
    met = many.withColumnRenamed("id", "x").join(unsettled, "sign").filter((F.col("x") < F.col("y")) & _possible("n", "yn", "parity", "yparity", percent))
    more = materialize(met.select("x", "y").distinct(), "line-pairs")
    discard(*parts)
    _free_shuffles(texts)
    late = matching_sets(texts, numbered, more, percent)

    earliest = settled.unionByName(late).groupBy(F.col("y").alias("id")).agg(F.min("x").alias("near"))
    earliest = materialize(earliest, "line-earliest")
    keep = F.least("id", F.coalesce("near", "id"))
    repeats = folded.join(_small(earliest, earliest.count()), "id", "left").filter((F.col("count") > 1) | F.col("near").isNotNull()).select("h1", "h2", keep.alias("keep"))
    repeats = materialize(repeats, "line-keep")
    gone = lines.join(_small(repeats, repeats.count()), ["h1", "h2"]).filter("id > keep").select("id").distinct()
    line = F.col("id").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int")
    gone = gone.groupBy(F.shiftright("id", LINE_BITS).alias("num")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    gone = materialize(gone.join(numbered, "num").select("doc", "row", "lines"), "line-repeats")
    discard(numbered, lines, folded, pairs, more, settled, late, earliest, repeats)
    return gone


def drop_lines(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of text; all columns and rows stay."""
    repeats = repeats.select(F.col("row").alias("__row"), F.col("doc").alias("__doc"), F.col("lines").alias("__lines"))
    size = repeats.agg(F.sum(F.size("__lines"))).first()[0] or 0
    doc, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    keyed = docs.withColumns({"__row": F.xxhash64(doc, text), "__doc": F.coalesce(doc, F.lit(2**63 - 1))})
    joined = keyed.join(_small(repeats, size), ["__row", "__doc"], "left")
    joined = joined.withColumn("__split", F.when(F.col("__lines").isNotNull(), F.split("text", "\n")))
    joined = joined.withColumn("__kept", F.array_except(F.sequence(F.lit(0), F.size("__split") - 1), "__lines"))
    kept = F.array_join(F.transform("__kept", lambda i: F.get("__split", i)), "\n")
    return joined.withColumn("text", F.when(F.col("__lines").isNull(), F.col("text")).otherwise(kept)).select(docs.columns)


def dedup_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without the lines that match an earlier line.

    ``docs`` needs doc_id and text and may hold any other columns but ``__row``,
    ``__doc``, ``__lines``, ``__split`` and ``__kept``. Lines end at a line feed; a line without words
    matches nothing and stays. The first line of a set of matches stays: order
    is doc_id (null ids last, by a hash of the text), then line number. Rows that
    repeat an id and text count as one document, and all keep what it keeps. A
    document that loses every line stays, with an empty text; a null text stays
    null. An empty table gives an empty table.
    """
    return drop_lines(docs, repeated_lines(docs, percent))
