"""Benchmark decontamination by template canonicalisation (operator 7), native Spark only.

Texts and benchmark items become templates: numbers, capitalised names and
units turn into typed placeholders, other words into lower case. Windows of
``WINDOW`` template tokens are hashed on both sides and joined; a window with
a name is hashed a second time with names as lower-case words, which finds
copies whose case was changed. Windows with fewer than ``LITERALS`` words that
are not placeholders say too little by themselves. An item that has no other
window is compared whole, found by its window with the most plain words; if
even that has fewer than ``PLAIN`` of them, its words and values must be the
same, and the key is made of them: a run of numbers never meets all others. An
item of fewer than ``LINE`` tokens counts where it is a line of its own.

Windows that align (same document, item and offset) must agree on their slots:
one benchmark value always stands for one document value and the other way
round, over at least the share ``COVER`` of the item's windows. So a question
whose numbers or names were exchanged is caught, and an accidental mix is not.
Unchanged windows count without the others of their alignment if they are
``LONG`` (a run of 13 tokens) or cover that share; one common phrase of eight
words is no leak.

Documents are read twice: once for the hashes of their windows, carried without
their texts, and again only those with a hash of the benchmark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import materialize

WINDOW, LITERALS, PLAIN, LINE = 8, 5, 2, 3
#: Least share of an item's windows in an alignment; of the same tokens in an item compared whole.
COVER, UNCHANGED = 0.5, 0.5
#: Unchanged windows that count whatever the item's length.
LONG = 6
#: Hashes or rows (two longs) up to which a side is broadcast after it was counted.
BROADCAST_ROWS = 200_000
#: Bytes of benchmark windows up to which they are broadcast after they were counted.
BROADCAST_BYTES = 32 << 20
TOKEN = r"[0-9]+(?:[.,:/][0-9]+)*|\p{L}+|[%$€£°]"
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
UNITS = (
    "km cm mm kg mg ml mph kmh lb lbs oz ft hour hours minute minutes second seconds day days week weeks month months year years "
    "mile miles meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters gram grams kilogram kilograms "
    "liter liters litre litres gallon gallons inch inches foot feet yard yards ton tons pound pounds dollar dollars euro euros cent cents "
    "percent degree degrees % $ € £ °"
).split()


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def lowered(tokens: str) -> Column:
    return F.transform(tokens, lambda t: F.lower(t))


def templates(tokens: str, low: str) -> Column:
    """Placeholders of numbers, units and capitalised names; other words in lower case.

    ``low`` holds the tokens in lower case. A token that starts with a digit is a number.
    """
    def kind(t: Column, l: Column) -> Column:
        word = F.when(l.isin(UNITS), UNIT).otherwise(l)
        same = F.when((l >= "0") & (l < ":"), NUMBER).otherwise(word)
        return F.when(l == t, same).when(F.initcap(t) == t, NAME).otherwise(word)

    return F.zip_with(tokens, low, kind)


def folded(template: str | Column, low: str | Column) -> Column:
    """A template whose names are words in lower case."""
    return F.zip_with(template, low, lambda t, l: F.when(t == NAME, l).otherwise(t))


def _is_slot(token: Column) -> Column:
    return token.isin(NUMBER, NAME, UNIT)


def _starts(size: Column, width: Column) -> Column:
    return F.when(size >= width, F.sequence(F.lit(1), size - width + 1)).otherwise(F.array().cast("array<int>"))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _joined(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def _window_hashes(levels: dict[int, Column], width: int) -> Column:
    """Hash of the run of ``width`` tokens at each place, from those of runs of 1, 2, 4, … tokens.

    The last places, where fewer tokens follow, have hashes of no window.
    """
    done, out = 0, None
    for power, block in levels.items():
        if width & power:
            shifted = _shifted(block, done) if done else block
            out = shifted if out is None else _joined(out, shifted)
            done += power
    return out


def _powers(most: int) -> list[int]:
    return [1 << k for k in range(most.bit_length())]


def _with_levels(read: DataFrame, name: str, most: int) -> DataFrame:
    """Token hashes ``name`` and, as columns, those of runs of 2, 4, … up to ``most`` tokens.

    Each level is a column of its own: inside one expression Spark would work
    out the lower levels again for each of their uses.
    """
    read = read.withColumn(f"{name}_1", F.col(name))
    for power in _powers(most)[1:]:
        half = F.col(f"{name}_{power // 2}")
        read = read.withColumn(f"{name}_{power}", _joined(half, _shifted(half, power // 2)))
    return read


def _window_hash(tokens: Column, width: int) -> Column:
    """Hash of the first ``width`` of a few ``tokens``, as ``_window_hashes`` has it for each place."""
    levels = {1: F.transform(tokens, lambda t: F.xxhash64(t))}
    for power in _powers(width)[1:]:
        levels[power] = _joined(levels[power // 2], _shifted(levels[power // 2], power // 2))
    return F.get(_window_hashes(levels, width), F.lit(0))


def _hash_of_width(tokens: Column, width: str, most: int) -> Column:
    """``_window_hash`` where the width is a column of values 1 to ``most``."""
    return reduce(lambda rest, w: F.when(F.col(width) == w, _window_hash(tokens, w)).otherwise(rest), range(1, most + 1), F.lit(None).cast("long"))


def benchmark_windows(items: DataFrame, width: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """(item_id, place, lead, width, kind, hash, template, raw, of): each telling window, and each item without one.

    ``hash`` is that of the ``width`` tokens behind the first ``lead``; kind is
    ``window``, ``whole`` (found by its template), ``values`` (found by its own
    words) or ``line``; ``of`` is the number of the item's windows. Windows with
    names come a second time, names as words in lower case.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null").distinct()
    rows = rows.select("item_id", tokens_of(F.col("text")).alias("words")).distinct().withColumn("low", lowered("words")).withColumn("all", templates("words", "low"))
    rows = rows.withColumn("width", F.least(F.lit(width), F.size("words"))).filter("width > 0")

    def plain(i: Column) -> Column:
        return F.size(F.filter(F.slice("all", i, F.col("width")), lambda t: ~_is_slot(t)))

    window = F.transform(_starts(F.size("words"), F.col("width")), lambda i: F.struct(plain(i).alias("plain"), (-i).alias("back")))
    rows = rows.withColumn("windows", window).withColumn("best", F.array_max("windows"))
    telling = rows.filter(F.col("best.plain") >= literals).withColumn("places", F.transform(F.filter("windows", lambda x: x["plain"] >= literals), lambda x: -x["back"]))
    telling = telling.select("item_id", F.explode("places").alias("place"), F.lit(0).alias("lead"), "width", F.lit("window").alias("kind"), "all", "words", F.size("places").alias("of"))
    telling = telling.select("item_id", "place", "lead", "width", "kind", F.slice("all", F.col("place"), F.col("width")).alias("template"), F.slice("words", F.col("place"), F.col("width")).alias("raw"), "of")
    dense = rows.filter(F.col("best.plain") < literals)
    kind = F.when(F.size("words") < LINE, "line").when(F.col("best.plain") < PLAIN, "values").otherwise("whole")
    lead = F.when(kind == "whole", -F.col("best.back") - 1).otherwise(0)
    template = F.when(kind == "whole", F.col("all")).otherwise(F.col("low"))
    dense = dense.select("item_id", F.lit(1).alias("place"), lead.alias("lead"), "width", kind.alias("kind"), template.alias("template"), F.col("words").alias("raw"), F.lit(1).alias("of"))
    rows = telling.unionByName(dense)
    named = rows.filter(F.col("kind").isin("window", "whole") & F.array_contains("template", NAME))
    rows = rows.unionByName(named.withColumn("template", folded("template", lowered("raw"))))
    keyed = rows.withColumn("hash", _hash_of_width(F.slice("template", F.col("lead") + 1, F.col("width")), "width", width))
    return keyed.withColumn("hash", F.when(F.col("kind") == "line", F.xxhash64("kind", "hash")).otherwise(F.col("hash")))


def _found_windows(texts: DataFrame, windows: DataFrame, small: bool) -> DataFrame:
    """(doc_id, row, at, as, hash) of document windows whose hash the benchmark has.

    ``as`` tells what was hashed: a template (names as placeholders or as words), values or a line.
    """
    known = windows.select("hash").distinct()
    known = F.broadcast(known) if small else known
    shapes = {(r.width, r.kind) for r in windows.select("width", "kind").distinct().collect()}  # at most 4 kinds of WINDOW widths
    telling = sorted({w for w, kind in shapes if kind in ("window", "whole")})
    values = sorted({w for w, kind in shapes if kind == "values"})
    read = texts.select("doc_id", "row", tokens_of(F.col("text")).alias("tokens")).withColumn("low", lowered("tokens")).withColumn("all", templates("tokens", "low"))
    readings = {"template": F.col("all"), "folded": folded("all", "low")} if telling else {}
    readings |= {"values": F.col("low")} if values else {}
    read = read.select("doc_id", "row", *(F.transform(c, lambda t: F.xxhash64(t)).alias(name) for name, c in readings.items()))
    for name in readings:
        widths = values if name == "values" else telling
        read = _with_levels(read, name, max(widths))
        levels = {power: F.col(f"{name}_{power}") for power in _powers(max(widths))}
        for w in widths:
            read = read.withColumn(f"{name}_of_{w}", _window_hashes(levels, w))
    # one array of hashes, a stretch of n places for each width and reading: no row carries more than a number
    stretches, kinds = [], []
    for w in telling:
        stretches.append(F.col(f"template_of_{w}"))
        # only places with a name have a second reading
        stretches.append(F.zip_with(f"template_of_{w}", f"folded_of_{w}", lambda a, b: F.when(a != b, b)))
        kinds += ["template", "template"]
    stretches += [F.col(f"values_of_{w}") for w in values]
    kinds += ["values"] * len(values)
    found = None
    if stretches:
        n = F.size(next(iter(readings)))
        # outer: for an inner explode Spark works out its arrays once more, to filter on their size
        found = read.select("doc_id", "row", n.alias("n"), F.posexplode_outer(F.concat(*stretches)).alias("pos", "hash")).join(known, "hash", "left_semi")
        kind = F.element_at(F.array(*map(F.lit, kinds)), (F.floor(F.col("pos") / F.col("n")) + 1).cast("int"))
        found = found.select("hash", "doc_id", "row", (F.col("pos") % F.col("n") + 1).alias("at"), kind.alias("as"))
    lines = sorted({w for w, kind in shapes if kind == "line"})
    if lines:
        short = texts.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("low", lowered(tokens_of(F.col("line"))))
        short = short.filter(F.size("low").isin(lines)).withColumn("width", F.size("low"))
        short = short.select("doc_id", "row", "at", F.xxhash64(F.lit("line"), _hash_of_width(F.col("low"), "width", max(lines))).alias("hash"), F.lit("line").alias("as"))
        short = short.join(known, "hash", "left_semi")
        found = short if found is None else found.unionByName(short)
    return found


def _said(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, row, as, start, length, said): the tokens of each wanted span, texts read and split once a document."""
    wanted = spans.groupBy("doc_id", "row").agg(F.collect_set(F.struct("as", "start", "length")).alias("spans"))  # of one document
    wanted = materialize(wanted.toDF("in_doc", "in_row", "spans"), "window-spans")
    asked = wanted.select(F.col("in_row").alias("row")).distinct()
    asked = F.broadcast(asked) if wanted.count() <= BROADCAST_ROWS else asked
    some = texts.join(asked, "row", "left_semi").dropDuplicates(["doc_id", "row"])
    both = some.join(wanted, (F.col("row") == F.col("in_row")) & F.col("doc_id").eqNullSafe(F.col("in_doc"))).select("doc_id", "row", "spans", "text")
    both = both.withColumn("lines", F.split("text", "\n")).withColumn("tokens", tokens_of(F.col("text")))

    def cut(s: Column) -> Column:
        said = F.when(s["as"] == "line", tokens_of(F.get("lines", s["start"]))).otherwise(F.slice("tokens", F.greatest(s["start"], F.lit(1)), s["length"]))
        return F.struct(s["as"].alias("as"), s["start"].alias("start"), s["length"].alias("length"), said.alias("said"))

    return both.select("doc_id", "row", F.explode(F.transform("spans", cut)).alias("s")).select("doc_id", "row", "s.*")


def contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """One row per document and benchmark item it leaks: doc_id, row, item_id, n_windows, n_verbatim.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns
    are ignored, whatever their names. n_windows counts the consistent matching
    windows (1 for an item compared whole), n_verbatim those with unchanged slots
    (numbers, names and units compared in lower case). ``row`` is a hash of id and
    text. Null or empty texts and null item ids match nothing; a null doc_id is
    reported as null; repeated documents or items are reported once; empty tables
    give an empty table. Texts of any length are read whole.
    """
    windows = materialize(benchmark_windows(items, width, literals), "benchmark-windows")
    measure = F.sum(F.octet_length(F.concat_ws(" ", "template")) + F.octet_length(F.concat_ws(" ", "raw")) + 128)
    rows, size = windows.agg(F.count("*"), F.coalesce(measure, F.lit(0))).first()
    doc, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    texts = docs.select(doc.alias("doc_id"), F.xxhash64(doc, F.col("text")).alias("row"), text.alias("text"))
    found = _found_windows(texts, windows, rows <= BROADCAST_ROWS)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, row long, item_id long, n_windows long, n_verbatim long")
    found = materialize(found.distinct(), "window-hits")
    hits = found.join(F.broadcast(windows) if size <= BROADCAST_BYTES else windows, "hash")
    hits = hits.filter(F.col("as") == F.when(F.col("kind").isin("values", "line"), F.col("kind")).otherwise("template"))
    start = F.when(F.col("as") == "line", F.col("at")).otherwise(F.col("at") - F.col("lead"))
    hits = hits.withColumn("start", start).withColumn("length", F.size("template")).filter("start > 0 or `as` = 'line'").drop("hash", "at", "lead", "width")
    hits = materialize(hits, "window-candidates")
    said = _said(texts, hits.select("doc_id", "row", "as", "start", "length").distinct())
    said = said.toDF(*(f"in_{c}" for c in said.columns))
    same_span = [F.col(c) == F.col(f"in_{c}") for c in ("row", "as", "start", "length")] + [F.col("doc_id").eqNullSafe(F.col("in_doc_id"))]
    found = hits.join(said, reduce(lambda a, b: a & b, same_span)).select(*hits.columns, F.col("in_said").alias("said"))
    # the hash only proposes
    found = found.withColumn("low", lowered("said")).withColumn("all", templates("said", "low"))
    template = F.col("template")
    same_template = (F.col("as") == "template") & ((F.col("all") == template) | (folded("all", "low") == template))
    found = found.filter(same_template | ((F.col("as") != "template") & (F.col("low") == template)))
    slots = F.filter(F.arrays_zip("template", "raw", "said"), lambda s: _is_slot(s["template"]))
    slots = F.transform(slots, lambda s: F.struct(F.lower(s["raw"]).alias("item"), F.lower(s["said"]).alias("doc")))
    found = found.withColumn("slots", slots).withColumn("unchanged", F.forall("slots", lambda s: s["item"] == s["doc"]))
    same = F.size(F.filter(F.arrays_zip("raw", "low"), lambda s: F.lower(s["raw"]) == s["low"]))
    found = found.filter((F.col("kind") != "whole") | F.col("unchanged") | (same >= UNCHANGED * F.size("template")))
    # windows of one alignment: at most as many as the item has
    aligned = found.groupBy("doc_id", "row", "item_id", (F.col("start") - F.col("place")).alias("offset"), (F.col("as") == "line").alias("line")).agg(
        F.size(F.collect_set("place")).alias("n"),
        F.size(F.collect_set(F.when(F.col("unchanged"), F.col("place")))).alias("verbatim"),
        F.max("of").alias("of"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    consistent = (F.size("slots") == F.size(F.array_distinct("slots.item"))) & (F.size("slots") == F.size(F.array_distinct("slots.doc")))
    alone = (F.col("verbatim") >= LONG) | (F.col("verbatim") >= COVER * F.col("of"))
    n = F.when(consistent & (F.col("n") >= COVER * F.col("of")), F.col("n")).when(alone, F.col("verbatim")).otherwise(0)
    aligned = aligned.withColumn("n", n).filter("n > 0")
    return aligned.groupBy("doc_id", "row", "item_id").agg(F.sum("n").alias("n_windows"), F.sum("verbatim").alias("n_verbatim"))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """``docs`` without the rows that leak a benchmark item, all columns (but no ``__row``, ``__doc``) kept."""
    leaks = materialize(contaminated(docs, items, width, literals).select(F.col("row").alias("__row"), F.col("doc_id").alias("__doc")).distinct(), "leaks")
    leaks = F.broadcast(leaks) if leaks.count() <= BROADCAST_ROWS else leaks
    keyed = docs.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    match = (keyed["__row"] == leaks["__row"]) & keyed["doc_id"].cast("long").eqNullSafe(leaks["__doc"])
    return keyed.join(leaks, match, "left_anti").select(docs.columns)
