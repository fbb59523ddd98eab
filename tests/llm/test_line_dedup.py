"""Operator 4 against a brute-force version."""

import random
import re

import pytest
from postlake.llm import line_dedup


def brute(rows, percent=80):
    """rows: (doc_id, text); what drop_lines leaves of each text."""
    lines = []
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            words = {w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w}
            if words:
                lines.append(((2**63 - 1 if i is None else i, k), words))
    kept = []
    for i, t in rows:
        if t is None:
            kept.append(None)
            continue
        left = []
        for k, line in enumerate(t.split("\n")):
            words = {w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w}
            at = (2**63 - 1 if i is None else i, k)
            if not any(o < at and 100 * len(words & ws) >= percent * len(words | ws) for o, ws in lines if words):
                left.append(line)
        kept.append("\n".join(left))
    return kept


def corpus(rng, n):
    vocab = ["the", "of", "and", "in", "a"] + [f"w{k}" for k in range(60)]
    lines = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 14))) for _ in range(n)]
    texts = []
    for _ in range(n):
        own = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(lines).split()
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(vocab)
            own.append("\t ".join(line).title() if rng.random() < 0.2 else " ".join(line))
        texts.append("\n".join(own))
    return texts


@pytest.mark.parametrize("percent", [80, 60, 100])
def test_equals_brute_force(spark, docs_of, percent):
    texts = corpus(random.Random(percent), 60) + [None, "", "\n\n", "a\n\na", "Ünïcode Ü\nünïcode ü", "lone " + "x" * 5000 + " \nlast"]
    rows = list(enumerate(texts)) + [(None, "a line of its own\nw1 w2 w3 w4 w5")]
    docs = docs_of([t for _, t in rows], [i for i, _ in rows], line=["x"] * len(rows), words=["y"] * len(rows))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, percent).collect()}
    assert got == dict(zip([i for i, _ in rows], brute(rows, percent), strict=True))


def test_repeated_rows_keep_the_same(spark, docs_of):
    got = line_dedup.dedup_lines(docs_of(["p q r\ns t u", "p q r\ns t u", "p q r"], [1, 1, 2])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "p q r\ns t u"), (1, "p q r\ns t u"), (2, "")]


def test_shuffled_sides_give_the_same(spark, docs_of, monkeypatch):
    texts = corpus(random.Random(4), 40)
    docs = docs_of(texts)
    before = sorted(map(tuple, line_dedup.dedup_lines(docs).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, line_dedup.dedup_lines(docs).collect())) == before


def test_many_lines_in_one_document(spark, docs_of):
    lines = [f"line {k} of a long document with {k * 7} words" for k in range(12_000)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(["\n".join(lines), "\n".join([*lines[::-1], "one more"])])).collect()}
    assert got[1] == "one more" and got[0].split("\n")[0] == lines[0]


def test_work_tables_are_deleted(spark, docs_of):
    import os

    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).removeprefix("file:")
    before = set(os.listdir(base))
    line_dedup.dedup_lines(docs_of(corpus(random.Random(8), 20))).count()
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(base)) - before} <= {"line-repeats"}


def test_no_rows_and_no_python(spark, docs_of):
    assert line_dedup.dedup_lines(docs_of([])).count() == 0
    plan = line_dedup.dedup_lines(docs_of(["a b c"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_lines_that_share_single_words_are_not_paired(spark, docs_of, monkeypatch):
    rng, kept, counts = random.Random(3), line_dedup.materialize, []

    def counted(df, purpose):
        out = kept(df, purpose)
        if purpose == "line-pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    lines = [" ".join(f"w{k}" for k in rng.sample(range(20_000), 200)) for _ in range(80)]
    near = lines[7].rsplit(" ", 5)[0] + " some other words at last"
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of([*lines, near])).collect()}
    assert got == {**dict(enumerate(lines)), 80: ""}
    assert 1 <= sum(counts) <= 200


@pytest.mark.parametrize("percent", [80, 51, 50, 30])
def test_small_sets_that_differ_by_words_at_the_ends(spark, docs_of, percent):
    words = [f"{c}{k}" for k, c in enumerate("qwertyuiop")]
    texts = [" ".join(words[a:b]) for a in range(9) for b in range(a + 1, 11) if (a * b) % 3 != 1]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(texts), percent).collect()}
    assert got == dict(enumerate(brute(list(enumerate(texts)), percent)))


def test_wide_tables_are_gone_before_the_postings(spark, docs_of, monkeypatch):
    import os

    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).removeprefix("file:")
    before, kept, seen, parts = set(os.listdir(base)), line_dedup.materialize, [], []

    def watched(df, purpose):
        if purpose == "line-postings":
            seen.append({x.rsplit("-", 1)[0] for x in set(os.listdir(base)) - before})
        out = kept(df, purpose)
        if purpose == "line-postings":
            parts.append({r.sign for r in out.select("sign").collect()})
        return out

    monkeypatch.setattr(line_dedup, "materialize", watched)
    rows = list(enumerate(corpus(random.Random(11), 40)))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of([t for _, t in rows])).collect()}
    assert got == dict(enumerate(brute(rows)))
    assert len(parts) > 1 and all(parts) and not set.intersection(*parts)
    assert all("line-sets" not in tables and "line-prefixes" in tables for tables in seen)


def test_documents_are_numbered_in_order_over_partitions(spark, docs_of):
    ids = [5, -3, 2**63 - 2, 0, -(2**63), 7, 1] + list(range(100, 160))
    keyed = docs_of(["x"] * len(ids), ids).repartition(7).selectExpr("doc_id as doc", "0L as row")
    got = {r.doc: r.num for r in line_dedup._numbered(keyed.unionByName(keyed)).collect()}
    assert got == {doc: num for num, doc in enumerate(sorted(ids))}


def test_rows_that_repeat_an_id_and_text_post_once(spark, docs_of, monkeypatch):
    kept, posted = line_dedup.materialize, []

    def watched(df, purpose):
        out = kept(df, purpose)
        if purpose == "line-postings":
            posted.extend((r.sign, r.id) for r in out.select("sign", "id").collect())
        return out

    monkeypatch.setattr(line_dedup, "materialize", watched)
    texts = ["a b c d e f g h i j"] + ["a b c d e f g h i k"] * 20 + ["a b c d e f g h x y"] * 20
    ids = [0] + [1] * 20 + [2] * 20
    got = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(docs_of(texts, ids)).collect()}
    assert got == set(zip(ids, brute(list(zip(ids, texts))), strict=True))
    assert posted and len(posted) == len(set(posted))
