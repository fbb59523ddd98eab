"""Operator 7: exact passages, re-parameterised questions, and what must not match."""

import random
import re

import pytest
from postlake.llm import decontamination as dc

ITEM = "Tom has 12 red marbles and gives Anna 5 of them after 3 hours so how many marbles are left with Tom today"


@pytest.fixture()
def items(spark):
    return spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (None, "x"), (3, "what is it"), (4, "der kleine hund läuft schnell")], "item_id long, text string")


def leaks(docs, items, **kw):
    return {(r.doc_id, r.item_id): (r.n_windows, r.n_verbatim) for r in dc.contaminated(docs, items, **kw).collect()}


def test_exact_reparameterised_and_inconsistent(spark, docs_of, items):
    other = ITEM.replace("Tom", "Sue").replace("Anna", "Max").replace("12", "40").replace("hours", "days")
    broken = ITEM.replace("Tom has 12", "Sue has 40").replace("with Tom", "with Max")
    texts = [f"some words before. {ITEM} and after", other, broken, "nothing of the kind here, only plain words in a row", None, "", "What is it", "Der kleine Hund läuft schnell", "der KLEINE hund läuft schnell", ITEM.upper()]
    got = leaks(docs_of(texts, hash=["x"] * len(texts), raw=["y"] * len(texts)), items)
    assert got[0, 1][0] == got[0, 1][1] > 5
    assert got[1, 1][0] > got[1, 1][1]
    assert {d for d, _ in got} == {0, 1, 2, 6, 7, 8, 9}  # 6 and 7: whole items in another case
    assert got[2, 1][0] == got[2, 1][1]  # only windows with unchanged slots count there
    assert (6, 3) in got and (7, 4) in got and (8, 4) in got


def test_slots_must_agree(spark, docs_of, items):
    # every window holds a changed slot, and Tom becomes two people: no leak
    item = spark.createDataFrame([(7, "Tom saw one of them near Tom while he was away from Tom")], "item_id long, text string")
    good = "Sue saw one of them near Sue while he was away from Sue"
    bad = "Sue saw one of them near Max while he was away from Kim"
    got = leaks(docs_of([good, bad]), item)
    assert (0, 7) in got and (1, 7) not in got


def test_rows_are_dropped_and_columns_kept(spark, docs_of, items):
    docs = docs_of([ITEM, "clean words", None, "clean words", ITEM], [1, 2, 3, 2, None], item_id=["a"] * 5, n_chars=[1] * 5)
    left = dc.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(2, "clean words"), (2, "clean words"), (3, "")]


def test_shuffled_join_gives_the_same(spark, docs_of, items, monkeypatch):
    docs = docs_of([f"x {ITEM}", "clean", ITEM])
    before = leaks(docs, items)
    monkeypatch.setattr(dc, "BROADCAST_ROWS", -1)
    assert leaks(docs, items) == before
    assert [r.doc_id for r in dc.decontaminate(docs, items).collect()] == [1]


def test_empty_tables(spark, docs_of, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(docs_of([]), items).count() == 0
    assert dc.contaminated(docs_of([ITEM]), none).count() == 0
    assert dc.decontaminate(docs_of([ITEM]), none).count() == 1


def test_items_without_a_telling_window(spark, docs_of):
    texts = ["What is the capital of France?", "What is 17 times 23?", "Wer schrieb den Roman Die Verwandlung?", "Tom has 5 apples. Anna has 3 apples. Ben has 4 apples."]
    item = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = [f"so: {t} and" for t in texts] + ["What is 40 times 51?", "Sue has 7 apples. Max has 2 apples. Kim has 9 apples.", "Anna met Ben with Tom and 3 others", texts[3].lower(), texts[0].lower()]
    got = leaks(docs_of(docs), item)
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 1), (5, 3), (7, 3), (8, 0)}
    assert got[0, 0] == (1, 1) and got[4, 1] == (1, 0)


def test_copies_in_another_case(spark, docs_of):
    text = "the river Rhine runs past Cologne and then on to the sea at Rotterdam"
    item = spark.createDataFrame([(1, text), (2, text.lower())], "item_id long, text string")
    got = leaks(docs_of([text.lower(), text.upper(), text.title()]), item)
    assert set(got) == {(d, i) for d in range(3) for i in (1, 2)}


def test_one_window_is_no_leak(spark, docs_of):
    famous = "Paris is one of the most famous Cities"
    item = spark.createDataFrame([(1, f"{famous} and many people go there every year to see the tower by the river")], "item_id long, text string")
    got = leaks(docs_of(["Einstein is one of the most famous Germans", f"we read that {famous}"]), item)
    assert got == {}  # eight words of an item of 22
    longer = f"we read that {famous} and many people go"
    assert leaks(docs_of([longer]), item) == {(0, 1): (5, 5)} if dc.LONG <= 5 else leaks(docs_of([longer + " there every"]), item)[0, 1][1] >= dc.LONG


def test_common_phrases_are_no_leak(spark, docs_of):
    item = spark.createDataFrame([(1, "the committee met in spring and decided that at the end of the day we will see whether the plan for the new bridge over the river holds")], "item_id long, text string")
    text = "Stir the sauce and at the end of the day we will see how it tastes, then serve"
    assert leaks(docs_of([text]), item) == {}


def test_short_items_and_tables_of_numbers(spark, docs_of):
    items = ["Capital of France?", "Define photosynthesis briefly please", "Why?", "1 2 3 4 5 6 7 8 9 10 11 12", "Who was it"]
    item = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = ["so: Capital of France? yes", "please define photosynthesis briefly please", "a\n WHY?!\nb", "and why not", "9 8 7 6 5 4 3 2 1 0 9 8 7 6", "x 1 2 3 4 5 6 7 8 9 10 11 12 y", "Capital of Spain?", "capital OF france", "Who was it", ""]
    got = leaks(docs_of(docs), item)
    assert set(got) == {(0, 0), (1, 1), (2, 2), (5, 3), (7, 0), (8, 4)}


def test_long_text_takes_linear_work(spark, docs_of):
    words = [f"w{k % 997} The" for k in range(25_000)]
    words[20_000] = ITEM
    got = leaks(docs_of([" ".join(words)]), spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert got[0, 1][0] == got[0, 1][1] > 5


def brute(docs, items):
    """The rules of the module on every alignment of every item."""
    token = re.compile(r"[0-9]+(?:[.,:/][0-9]+)*|[^\W\d_]+|[%$€£°]")
    slot = {dc.NUMBER, dc.NAME, dc.UNIT}

    def kind(t):
        low = t.lower()
        return dc.NUMBER if t[0].isdigit() else dc.NAME if low != t and t[:1].upper() + t[1:].lower() == t else dc.UNIT if low in dc.UNITS else low

    def read(text):
        t = token.findall(text or "")
        m = [kind(x) for x in t]
        return t, m, [x.lower() if y == dc.NAME else y for x, y in zip(t, m, strict=True)], [x.lower() for x in t]

    out = {}
    for doc, text in set(docs):
        t, m, f, low = read(text)
        lines = [read(x)[3] for x in (text or "").split("\n")]
        for item, said in {(i, x) for i, x in items if i is not None and x is not None}:
            bt, bm, bf, bl = read(said)
            w = min(8, len(bt))
            plain = [sum(x not in slot for x in bm[p : p + w]) for p in range(len(bt) - w + 1)] if w else []
            total = verbatim_total = 0
            if w and max(plain) < 5 and (len(bt) < 3 or max(plain) < 2):
                total = verbatim_total = sum(x == bl for x in lines) if len(bt) < 3 else sum(low[o : o + len(bt)] == bl for o in range(len(t)))
            elif w:
                whole = max(plain) < 5
                places = [(0, len(bt))] if whole else [(p, p + w) for p, n in enumerate(plain) if n >= 5]
                for off in range(-len(bt), len(t)):
                    hit, same, pairs = set(), set(), set()
                    for p, q in places:
                        if off + p < 0 or off + q > len(t):
                            continue
                        for reading in (bm[p:q], bf[p:q]):
                            if reading not in (m[off + p : off + q], f[off + p : off + q]):
                                continue
                            mine = {(bl[k], low[off + k]) for k in range(p, q) if reading[k - p] in slot}
                            equal = all(a == b for a, b in mine)
                            if whole and not equal and sum(bl[k] == low[off + k] for k in range(p, q)) < 0.5 * (q - p):
                                continue
                            hit.add(p)
                            pairs |= mine
                            if equal:
                                same.add(p)
                    agree = len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
                    n = len(hit) if agree and len(hit) >= 0.5 * len(places) else len(same) if len(same) >= 6 or len(same) >= 0.5 * len(places) else 0
                    if n and hit:
                        total, verbatim_total = total + n, verbatim_total + len(same)
            if total:
                out[doc, item] = (total, verbatim_total)
    return out


def random_case(seed):
    rng = random.Random(seed)
    words = "the a of Tom Anna Paris 3 17 5,000 km hours dollar red run saw house when is and many people it".split()
    items = [(k, rng.choice(["", "so "]) + " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 12, 20, 30])))) for k in range(40)]
    swap = dict(zip(["Tom", "Anna", "Paris", "3", "17", "km"], ["Ben", "Kim", "Rome", "4", "12", "hours"], strict=True))
    docs = []
    for k in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            t = rng.choice(items)[1]
            how = rng.random()
            t = t if how < 0.3 else " ".join(swap.get(x, x) for x in t.split()) if how < 0.5 else t.lower() if how < 0.6 else t.upper() if how < 0.65 else " ".join(t.split()[: rng.randint(0, 25)])
            parts += [t, " ".join(rng.choices(words, k=rng.randint(0, 6)))]
        docs.append((k, rng.choice([" ", "\n", ". "]).join(parts)))
    return docs + [(100, None), (101, ""), (3, docs[3][1])], items + [(50, None), (None, "the house"), (1, items[1][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_and_sql(spark, docs_of, seed):
    import duckdb
    import pandas as pd
    from postlake.llm.sql import OP7

    docs, items = random_case(seed)
    want = brute(docs, items)
    got = leaks(docs_of([t for _, t in docs], [i for i, _ in docs]), spark.createDataFrame(items, "item_id long, text string"))
    assert got == want and len(want) > 20
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame([(i, t) for i, t in items if i is not None], columns=["item_id", "text"]))
    assert {(d, i): (n, v) for d, i, n, v in con.sql(OP7).fetchall()} == want
