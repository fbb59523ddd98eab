"""The page-extraction job (H1-H11): ``mapInPandas`` over a page table.

Each task parses its pages one at a time with the stdlib HTML parser and
applies the page's rule list; the output per page is small (the extracted
inputs as JSON), so the HTML never reaches a shuffle. A page that fails to
parse becomes a row with ``parse_ok = false`` and the error text (H11); it
never fails the job. Everything after element → text runs as native
expressions (``postlake.plans.postings``).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators import htmltree
from postlake.operators.htmltree import Document, Node

# The mapper and the tree code travel inside the task closure (pickled by
# value), so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(htmltree)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXTRACT_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("parse_ok", T.BooleanType()),
        T.StructField("parse_error", T.StringType()),
        T.StructField("inputs", T.StringType()),
        T.StructField("page_text", T.StringType()),
    ]
)
INPUTS_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

Rule = tuple[str, str, str, dict]


def _has_text(nodes: list[Node], needle: str | None) -> list[Node]:
    if not needle:
        return nodes
    low = needle.lower()
    return [n for n in nodes if low in n.text("all").lower()]


def apply_rule(doc: Document, kind: str, selector: str, p: Mapping) -> list[str]:
    """One rule → list of strings (scalar kinds give zero or one item)."""
    mode = p.get("mode", "strip")
    if kind == "page_text":
        return [doc.text("all")]
    scope = None
    if p.get("scope"):
        scopes = doc.select(p["scope"])
        idx = p.get("scope_nth", 0)
        if idx >= len(scopes):
            return []
        scope = scopes[idx]
    if kind == "following":
        anchors = doc.select(selector)
        if not anchors:
            return []
        if p.get("each"):
            picked, seen = [], set()
            for a in anchors:
                nxt = doc.following(a, p["target"])
                k = p["each"]
                if len(nxt) >= k and nxt[k - 1].order not in seen:
                    seen.add(nxt[k - 1].order)
                    picked.append(nxt[k - 1])
            picked.sort(key=lambda n: n.order)
        else:
            picked = doc.following(anchors[0], p["target"])
        n = p.get("n", 1)
        return [picked[n - 1].text("raw")] if len(picked) >= n else []
    if kind == "label_next":
        # every label containing the text, in order → the next target's text
        out = []
        for label in doc.select(selector, scope):
            if p["contains"] in label.text("all"):
                nxt = doc.find_next(label, p.get("target", "p"))
                if nxt is not None:
                    out.append(nxt.text("strip"))
        return out
    if kind == "section_values":
        out, inside = [], False
        drops = {d.lower() for d in p.get("drop", [])}
        for row in doc.select(selector, scope):
            head = doc.select_one(p["heading"], row)
            if head is not None and p["contains"] in head.text("all"):
                inside = True
                continue
            if inside:
                for label in doc.select(p["labels"], row):
                    if p.get("exclude") and p["exclude"] in label.text("strip"):
                        continue
                    nxt = doc.find_next(label, p.get("target", "p"))
                    if nxt is not None:
                        value = nxt.text("strip")
                        if value and value.lower() not in drops:
                            out.append(value)
        return sorted(set(out))
    if kind == "section_text":
        parts = []
        for head in doc.select(selector, scope):
            low = head.text("strip").lower()
            if any(k in low for k in p["keywords"]):
                for sib in head.next_siblings():
                    if sib.tag in p["stop"] and sib.text("strip"):
                        break
                    if sib.tag == p["collect"] and sib.text("strip"):
                        parts.append(sib.text("strip"))
        if parts:
            return ["\n".join(parts)]
        fb = doc.select_one(p["fallback"], scope) if p.get("fallback") else None
        return [fb.text("strip")] if fb is not None else []

    nodes = _has_text(doc.select(selector, scope), p.get("has_text"))
    if kind == "exists":
        return ["1"] if nodes else []
    if kind == "attrs":
        return [n.attrs[p["attr"]] for n in nodes if p["attr"] in n.attrs]
    if kind == "texts":
        texts = [n.text(mode) for n in nodes]
        return texts if p.get("keep_blank") else [t for t in texts if t]
    if kind == "first_string":
        for n in nodes:
            for s in n.strings():
                return [s.strip()]
        return []
    idx = p.get("nth", 0)
    if idx >= len(nodes):
        return []
    node = nodes[idx]
    if kind == "text":
        return [node.text(mode)]
    if kind == "attr":
        val = node.attrs.get(p["attr"])
        return [val] if val is not None else []
    if kind == "strings":
        return node.stripped_strings()
    if kind == "script":
        return [node.raw_text()]
    raise ValueError(f"unknown rule kind {kind!r}")


def extract_inputs(html: str, rules: Sequence[Rule], repair: bool = False) -> dict[str, list[str]]:
    """Parse once, run the rules. Same-name rules are ordered fallbacks: an
    empty value falls through to the next rule (``a or b``), unless the rule
    has ``exists_wins`` — then a matched element ends the chain even when its
    text is empty."""
    doc = Document(html, repair=repair)
    out: dict[str, list[str]] = {}
    done: set[str] = set()
    for name, kind, selector, params in rules:
        if name in done:
            continue
        vals = apply_rule(doc, kind, selector, params)
        if name not in out or any(vals):
            out[name] = vals
        if any(vals) or (vals and params.get("exists_wins")):
            done.add(name)
    return out


def _mapper(rules_by_source: Mapping[str, Sequence[Rule]], passthrough: Sequence[str] = (),
            repair_sources: frozenset = frozenset()):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok, err, inputs, texts = [], [], [], []
            for html, source in zip(pdf["html"], pdf["source"]):
                try:
                    rules = rules_by_source.get(source)
                    if rules is None:
                        raise KeyError(f"no rules for source {source!r}")
                    found = extract_inputs(html, rules, repair=source in repair_sources)
                    # the page text is large: its own Arrow column, not JSON
                    text = found.pop("page_text", None)
                    texts.append(text[0] if text else None)
                    inputs.append(json.dumps(found, ensure_ascii=False))
                    ok.append(True)
                    err.append(None)
                except Exception as exc:  # one bad page never fails the job
                    inputs.append(None)
                    texts.append(None)
                    ok.append(False)
                    err.append(f"{type(exc).__name__}: {exc}"[:500])
            out = pd.DataFrame(
                {
                    "page_id": pdf["page_id"].astype("int64"),
                    "source": pdf["source"],
                    "url": pdf["url"],
                    "parse_ok": ok,
                    "parse_error": err,
                    "inputs": inputs,
                    "page_text": texts,
                }
            )
            for c in passthrough:
                out[c] = pdf[c].values
            yield out

    return run


def extract_pages(
    pages: DataFrame,
    rules_by_source: Mapping[str, Sequence[Rule]],
    passthrough: Sequence[str] = (),
    repair_sources: Sequence[str] = (),
) -> DataFrame:
    """Run the rule mapper over ``pages(page_id, source, url, html, ...)``.

    Returns ``page_id, source, url, parse_ok, parse_error, inputs,
    page_text`` where ``inputs`` is ``map<string, array<string>>`` (sent as
    JSON, parsed once natively) and ``page_text`` is filled only for rule sets
    with a ``page_text`` rule. The rules travel in the task closure (a few
    kB). Arrow batches are bounded by
    ``spark.sql.execution.arrow.maxBytesPerBatch`` / ``maxRecordsPerBatch``.
    ``passthrough`` columns (small, per page) are copied through unchanged so
    no join is needed afterwards. Pages of ``repair_sources`` are parsed with
    the HTML standard's implicit end tags (see ``htmltree.Document``).
    """
    passthrough = list(passthrough)
    src = pages.select(
        F.col("page_id").cast("long"), F.col("source"), F.col("url"), F.col("html"), *passthrough
    )
    schema = T.StructType(list(EXTRACT_SCHEMA.fields) + [src.schema[c] for c in passthrough])
    raw = src.mapInPandas(_mapper(dict(rules_by_source), passthrough, frozenset(repair_sources)), schema)
    return raw.withColumn("inputs", F.from_json("inputs", INPUTS_TYPE))
