"""Licence scans (operator 12): identifier tags and notice phrases by Aho-Corasick, expressions by shunting yard.

Two automata pass every whole text once: one over its words (A-Z lower-cased,
one blank between them) finds notice phrases, one over the lower-cased text
finds identifier tags such as ``SPDX-License-Identifier:``. What follows a tag
on its line is a licence expression: identifiers, ``and``, ``or``, ``with`` and
brackets, brought into postfix order by a shunting yard and evaluated to a
degree of openness: ``or`` leaves the choice and takes the greater, ``and``
binds both and takes the lesser, an exception behind ``with`` takes its licence
half of the way to 1. Several statements of a text bind together (the least
counts); a text without any is not licensed and has 0.

Scanning is map-only; a text is looked at as bytes, so nothing per word is held.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notice phrases of the contract and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notice phrases and their labels.
NOTICES = {
    "apache license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0": "cc0",
    "public domain": "public-domain",
    "the unlicense": "unlicense",
    "isc license": "isc",
    "eclipse public license": "epl",
}
# Identifier tags, as they stand before a licence expression.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:", "license =", "licence =")
# Openness of a licence family (0 reserved, 1 free of conditions).
OPENNESS = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0,
    "mit": 0.9, "isc": 0.9, "bsd": 0.9, "apache": 0.9, "zlib": 0.9, "cc-by": 0.8,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.4, "gpl": 0.3, "agpl": 0.2,
    "cc-by-nd": 0.2, "cc-by-nc": 0.1, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.05, "reserved": 0.0,
}
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[ \t\"']*([()]|[a-z0-9][a-z0-9.+:_-]*)")
#: Letters, digits and bytes of other characters in lower case, blanks for the rest; and the lower case alone.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def family(identifier: str) -> str | None:
    """The longest known family an identifier belongs to (``gpl-2.0-or-later`` is ``gpl``), or None."""
    name = identifier.rstrip("+.").removeprefix("licenseref-")
    parts = name.split("-")
    for k in range(len(parts), 0, -1):
        if "-".join(parts[:k]) in OPENNESS:
            return "-".join(parts[:k])
    return None


def expression_tokens(text: str, at: int = 0) -> list[str]:
    """The licence expression that starts at ``at``: it ends with the line or where the next token does not fit."""
    out: list[str] = []
    depth, operand = 0, True  # operand: one is due
    while m := TOKEN.match(text, at):
        token, at = m.group(1), m.end()
        if token == "(":
            if not operand:
                break
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            depth -= 1
        elif token in BINDS:
            if operand:
                break
            operand = True
        else:
            if not operand:
                break
            operand = False
        out.append(token)
    return out


def postfix(tokens: list[str]) -> list[str]:
    """Shunting yard: operands in order, each operator behind its two; open ends are closed or dropped."""
    out: list[str] = []
    waiting: list[str] = []
    tokens = list(tokens)
    while tokens and (tokens[-1] in BINDS or tokens[-1] == "("):  # nothing follows
        tokens.pop()
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if waiting:
                waiting.pop()
        elif token in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + [w for w in reversed(waiting) if w != "("]


def evaluate(order: list[str]) -> float | None:
    """Openness of a postfix expression; an unknown licence opens nothing, no operand gives None."""
    values: list[float] = []
    for token in order:
        if token not in BINDS:
            known = family(token)
            values.append(OPENNESS[known] if known else 0.0)
            continue
        right, left = values.pop(), values.pop()
        if token == "or":
            values.append(max(left, right))
        elif token == "and":
            values.append(min(left, right))
        else:
            values.append(left + (1.0 - left) / 2)
    return values[-1] if values else None


def _automaton(patterns: dict[str, object]) -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for text, value in patterns.items():
        auto.add_word(text, value)
    auto.make_automaton()
    return auto


class Scanner:
    """Finds statements in one text after the other."""

    def __init__(self):
        both = {p: (len(p), label, True) for p, label in BASE.items()} | {p: (len(p), label, False) for p, label in NOTICES.items()}
        self.phrases = _automaton({f" {p} ": v for p, v in both.items()})
        self.tags = _automaton({t: len(t) for t in TAGS})

    def scan(self, text: str) -> dict:
        data = text.encode()
        norm = re.sub(rb" +", b" ", b" " + data.translate(WORD_BYTES) + b" ")
        n_words = norm.count(b" ") - 1
        base, labels, starts, degrees = set(), set(), [], []
        line = norm.decode("latin-1")
        blanks = None
        for end, (size, label, is_base) in self.phrases.iter(line):
            if is_base:
                if blanks is None:
                    blanks = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
                starts.append(int(np.searchsorted(blanks, end - size - 1)))
                base.add(label)
            labels.add(label)
        degrees += [OPENNESS[x] for x in sorted(labels)]
        expressions = []
        low = data.translate(LOWER_BYTES).decode("latin-1")
        for end, size in self.tags.iter(low):
            first = end - size  # the byte before the tag
            if first >= 0 and (low[first].isalnum() or low[first] in "-_") and not size == len(TAGS[0]):
                continue  # the end of a longer name
            order = postfix(expression_tokens(low, end + 1))
            value = evaluate(order)
            named = [f for f in map(family, (t for t in order if t not in BINDS)) if f]
            if value is None or not named:
                continue
            labels.update(named)
            degrees.append(value)
            expressions.append(" ".join(order))
        return {
            "n_words": n_words, "n_base": len(starts),
            "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
            "score": min(degrees, default=0.0), "expressions": expressions,
        }


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(pa.string()))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        rows = [{"doc_id": i, **scanner.scan(t.as_py() or "")} for i, t in zip(ids, batch.column("text"), strict=True)]
        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: word count, notices, labels, openness (score) and tagged expressions in postfix order.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their
    names. n_base counts the places of the phrases of BASE, first_word and
    last_word are their least and greatest start (words from 0; null without
    any); base_labels and labels are distinct, sorted and joined by commas (the
    empty string without any). A null or empty text has no words and no labels.
    Each row gives one row, repeated ones and null ids included; an empty table
    gives an empty table. Texts of any length are read whole. A tag counts only
    where an expression with a known licence follows on its line.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCHEMA)
