"""Operator 12 against a brute-force version, and its expressions against hand-written values."""

import random
import re

import pytest
from postlake.llm import licenses as lic

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def brute(text):
    """(n_words, starts, labels of base phrases, labels of all phrases)."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    starts, base, labels = [], set(), set()
    for phrase, label in [*lic.BASE.items(), *lic.NOTICES.items()]:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                labels.add(label)
                if phrase in lic.BASE:
                    starts.append(k)
                    base.add(label)
    return len(words), starts, base, labels


def texts():
    rng = random.Random(12)
    bits = ["CC", "by", "cc-by", "All Rights", "reserved.", "GENERAL", "public", "license", "general public license", "MIT", "ünï", "naïve\x00", "Apache\nLicense", "x1", "cc0", "—", "BY-NC", "accc by", "cc bye", "Lesser"]
    out = [rng.choice([" ", "\n", "\t- "]).join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    return out + [None, "", " \n", "CC BY", "cc by cc by CC-BY", "all all rights reserved reserved", "w " * 60_000 + "all rights reserved"]


def test_equals_brute_force(spark, docs_of):
    rows = texts()
    docs = docs_of(rows, [*range(len(rows) - 1), None], labels=["l"] * len(rows), score=["s"] * len(rows))
    got = {r.doc_id: r for r in lic.scan_licenses(docs).collect()}
    assert len(got) == len(rows)
    for i, t in zip([*range(len(rows) - 1), None], rows, strict=True):
        n, starts, base, labels = brute(t)
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(starts), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(base)) and r.labels == ",".join(sorted(labels))
        assert r.score == min((lic.OPENNESS[x] for x in labels), default=0.0)


@pytest.mark.parametrize("text,order,value", [
    ("mit", "mit", 0.9),
    ("mit or gpl-2.0-only", "mit gpl-2.0-only or", 0.9),
    ("mit and gpl-3.0+", "mit gpl-3.0+ and", 0.3),
    ("mit or apache-2.0 and gpl-2.0", "mit apache-2.0 gpl-2.0 and or", 0.9),
    ("(mit or apache-2.0) and gpl-2.0", "mit apache-2.0 or gpl-2.0 and", 0.3),
    ("gpl-2.0-or-later with classpath-exception-2.0 and mit", "gpl-2.0-or-later classpath-exception-2.0 with mit and", 0.65),
    ("cc-by-nc-sa-4.0 or (cc-by-4.0", "cc-by-nc-sa-4.0 cc-by-4.0 or", 0.8),
    ("mit or", "mit", 0.9),
    ("(mit)) and gpl", "mit", 0.9),
    ("unheard-of and mit", "unheard-of mit and", 0.0),
    ("mit, see the file", "mit", 0.9),
    ("and mit", "", None),
    ("((", "", None),
    ("", "", None),
])
def test_expressions(text, order, value):
    got = lic.postfix(lic.expression_tokens(text))
    assert " ".join(got) == order and lic.evaluate(got) == pytest.approx(value) if value is not None else lic.evaluate(got) is None


def test_random_expressions_equal_python(spark):
    rng = random.Random(3)
    ids = ["mit", "gpl-2.0", "mpl-2.0", "cc0-1.0", "agpl-3.0"]

    def build(depth):
        if depth == 0 or rng.random() < 0.2:
            name = rng.choice(ids)
            return name, lic.OPENNESS[lic.family(name)]
        (a, x), (b, y) = build(depth - 1), build(depth - 1)
        return (f"({a} or {b})", max(x, y)) if rng.random() < 0.5 else (f"({a} and {b})", min(x, y))

    for _ in range(200):
        text, value = build(4)
        assert lic.evaluate(lic.postfix(lic.expression_tokens(text))) == value


def test_tags(spark, docs_of):
    rows = [
        "x\n// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode",
        "license: GPL-2.0-only WITH Classpath-exception-2.0",
        "the license: see below", "mylicense: mit", "License: MIT\nall rights reserved", "SPDX-License-Identifier:", "licence: MIT licence: gpl-3.0",
    ]
    got = {r.doc_id: (r.labels, r.score, r.expressions) for r in lic.scan_licenses(docs_of(rows)).collect()}
    assert got[0] == ("apache,bsd,mit", 0.9, ["mit apache-2.0 or bsd-3-clause and"])
    assert got[1] == ("gpl", pytest.approx(0.65), ["gpl-2.0-only classpath-exception-2.0 with"])
    assert got[2] == ("", 0.0, []) and got[3] == ("", 0.0, []) and got[5] == ("", 0.0, [])
    assert got[4] == ("mit,reserved", 0.0, ["mit"])
    assert got[6] == ("gpl,mit", 0.3, ["mit", "gpl-3.0"])


def test_repeated_rows_and_empty_tables(spark, docs_of):
    assert lic.scan_licenses(docs_of(["cc by"] * 3, [1, 1, 1])).count() == 3
    assert lic.scan_licenses(docs_of([])).count() == 0
