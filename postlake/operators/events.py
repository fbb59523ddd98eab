"""Native extraction of nested pages (H1-H8, H10, H11): an array of element events per page.

A page becomes one ordered array of events, one for each tag: its position,
whether it opens an element, its name, its attributes and the text up to the
next tag. The array is made once, by column expressions; every rule is then a
search in it:

* an element ends at the event that balances its tag (for sources read through
  a repairing parser, paragraphs, list items, cells and headings also end where
  the next of their kind starts);
* the next element of a kind, or the nth behind an anchor, is a look-up of
  positions;
* sections are folds over the events that carry whether the section is open.

Rules stay data (``rules.extraction``) and the output has the shape of the rule
mapper's (``operators.extract``), so everything behind it is shared. Selectors
may use a tag, ``#id``, ``.class``, ``[attr]``, ``[attr='v']``, ``[attr*='v']``,
groups (``,``) and descendants (a blank); ``split_rules`` parts a rule set into
what this form can run and what needs the tree.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import html as ph
from postlake.functions.text import strip

VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: Elements that end where the next of their kind starts, for repaired pages.
IMPLIED = ("p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6")
TAG = r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>([^<]*+(?:<(?![/a-zA-Z])[^<]*+)*+)"""
ATTRIBUTE = r"""([^\s"'=/>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
CUT_OFF = r"<[/a-zA-Z][^<>]*$"
STRINGS = "array<string>"
ATTRIBUTES = "array<struct<name:string,value:string>>"

Rule = tuple[str, str, str, dict]


def _attributes(markup: Column) -> Column:
    """(name, value) of each attribute, names in lower case."""
    value = F.regexp_extract_all(markup, F.lit(ATTRIBUTE), F.lit(2))
    plain = F.transform(value, lambda v: F.when(F.substring(v, 1, 1).isin('"', "'"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))
    name = F.transform(F.regexp_extract_all(markup, F.lit(ATTRIBUTE), F.lit(1)), lambda n: F.lower(n))
    return F.zip_with(name, plain, lambda n, v: F.struct(n.alias("name"), ph.decode_entities(v).alias("value")))


def with_events(pages: DataFrame, html: str = "html", out: str = "events") -> DataFrame:
    """``pages`` with the events of ``html`` as a column."""
    clean = pages.withColumn("__clean", ph.content_only(html))
    slash, name, markup, text = (F.regexp_extract_all("__clean", F.lit(TAG), F.lit(k)) for k in (1, 2, 3, 4))
    parts = clean.withColumn("__tags", F.arrays_zip(slash.alias("slash"), name.alias("tag"), markup.alias("markup"), text.alias("text")))
    event = F.transform("__tags", lambda t, i: F.struct(
        (i + 1).alias("pos"), (t["slash"] == "").alias("open"), F.lower(t["tag"]).alias("tag"),
        F.when(F.contains(t["markup"], F.lit("=")), _attributes(t["markup"])).otherwise(F.array().cast(ATTRIBUTES)).alias("attrs"), ph.decode_entities(t["text"]).alias("text")))
    return parts.withColumn(out, event).drop("__tags", "__clean")


def attribute(event: Column, name: str) -> Column:
    return F.get(F.filter(event["attrs"], lambda a: a["name"] == name), F.lit(0))["value"]


SIMPLE = re.compile(r"^([a-zA-Z][a-zA-Z0-9]*)?((?:#[\w-]+|\.[\w-]+|\[[^\]]+\])*)$")
PART = re.compile(r"#([\w-]+)|\.([\w-]+)|\[\s*([\w-]+)\s*(?:(\*?=)\s*['\"]?([^'\"\]]*)['\"]?\s*)?\]")


def parse_selector(selector: str) -> list[list[tuple[str, str]]]:
    """Groups of descendant chains; each link is (tag, conditions). ValueError for other forms."""
    groups = []
    for group in re.split(r",(?![^\[]*\])", selector):
        chain = []
        for link in re.split(r"\s+(?![^\[]*\])", group.strip()):
            m = SIMPLE.match(link)
            if not m or not link:
                raise ValueError(f"selector form not supported: {selector!r}")
            chain.append((m.group(1) or "", m.group(2)))
        groups.append(chain)
    return groups


def _matches(link: tuple[str, str]) -> Callable[[Column], Column]:
    tag, conditions = link

    def test(e: Column) -> Column:
        ok = e["open"]
        if tag:
            ok = ok & (e["tag"] == tag.lower())
        for ident, cls, attr, op, value in PART.findall(conditions):
            if ident:
                ok = ok & (attribute(e, "id") == ident)
            elif cls:
                ok = ok & F.array_contains(F.split(attribute(e, "class"), r"\s+"), cls)
            elif op == "=":
                ok = ok & (attribute(e, attr.lower()) == value)
            elif op == "*=":
                ok = ok & F.contains(attribute(e, attr.lower()), F.lit(value))
            else:
                ok = ok & attribute(e, attr.lower()).isNotNull()
        return F.coalesce(ok, F.lit(False))

    return test


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _within(found: Column, scopes: Column) -> Column:
    """Events or elements inside any of the ``scopes``."""
    return _let(scopes, lambda all_: F.filter(found, lambda e: F.exists(all_, lambda a: (a["pos"] < e["pos"]) & (e["pos"] < a["end"]))))


class Page:
    """Searches in one events column; elements are structs (pos, end, attrs)."""

    def __init__(self, events: Column | str = "events", repair: Column | bool = False):
        self.events = F.col(events) if isinstance(events, str) else events
        self.repair = repair if isinstance(repair, Column) else F.lit(repair)

    def end(self, e: Column) -> Column:
        """Position of the event that ends the element (one behind the last without any)."""
        start = F.struct(F.lit(1).alias("depth"), F.lit(None).cast("int").alias("end"))

        def step(acc: Column, x: Column) -> Column:
            depth = acc["depth"] + F.when(x["open"], 1).otherwise(-1)
            return F.when(acc["end"].isNotNull(), acc).otherwise(F.struct(depth.alias("depth"), F.when(depth == 0, x["pos"]).alias("end")))

        def ended(same: Column) -> Column:
            first = F.get(same, F.lit(0))
            implied = F.when(self.repair & e["tag"].isin(*IMPLIED), first["pos"])
            balanced = F.when(~first["open"], first["pos"]).otherwise(F.aggregate(same, start, step)["end"])  # mostly the next of the name closes it
            return F.coalesce(implied, balanced, F.size(self.events) + 1)

        same = F.filter(self.events, lambda x: (x["pos"] > e["pos"]) & (x["tag"] == e["tag"]))
        return F.when(e["tag"].isin(*VOID), e["pos"] + 1).otherwise(_let(same, ended))

    def _element(self, e: Column) -> Column:
        return F.struct(e["pos"].alias("pos"), self.end(e).alias("end"), e["attrs"].alias("attrs"))

    def chain(self, chain: Sequence[tuple[str, str]], scopes: Sequence[Column] = ()) -> Column:
        """Elements of a descendant chain, inside all ``scopes`` (array columns of elements)."""
        found = F.filter(self.events, _matches(chain[-1]))
        for scope in scopes:
            found = _within(found, scope)
        return F.transform(found, self._element)

    def parts(self, el: Column) -> Column:
        """Text nodes of an element, in order."""
        return _let(el, lambda e: F.transform(F.slice(self.events, e["pos"], F.greatest(e["end"] - e["pos"], F.lit(0))), lambda x: x["text"]))

    def strings(self, el: Column) -> Column:
        return F.filter(F.transform(self.parts(el), lambda t: strip(t)), lambda t: t != "")

    def text(self, el: Column, mode: str = "strip") -> Column:
        if mode == "all":
            return F.array_join(self.parts(el), "")
        if mode == "raw":
            return strip(F.array_join(self.parts(el), ""))
        return F.array_join(self.strings(el), "\n" if mode == "newline" else "")

    def following_at(self, position: Column, target: str, n: int = 1) -> Column:
        """The event of the nth ``target`` element that opens behind a position; null without."""
        behind = _let(position, lambda at: F.filter(self.events, lambda x: (x["tag"] == target) & x["open"] & (x["pos"] > at)))
        return F.get(behind, F.lit(n - 1))

    def following(self, position: Column, target: str, n: int = 1) -> Column:
        """The nth ``target`` element that opens behind a position; null without."""
        return _let(self.following_at(position, target, n), lambda nxt: F.when(nxt.isNotNull(), self._element(nxt)))

    def inside(self, outer: Column, test: Callable[[Column], Column]) -> Column:
        """Elements inside another that pass a test of their event."""
        return _let(outer, lambda o: F.transform(F.filter(self.events, lambda x: (x["pos"] > o["pos"]) & (x["pos"] < o["end"]) & test(x)), self._element))


def _some(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def _as_list(value: Column) -> Column:
    return _some(F.array(value))


def label_values(page: Page, labels: Column, contains: str, target: str = "p") -> Column:
    """H4: behind each label that contains the words, the text of the next target."""
    named = F.filter(labels, lambda el: F.contains(page.text(el, "all"), F.lit(contains)))
    return _some(F.transform(named, lambda el: page.text(page.following(el["pos"], target))))


def section_values(page: Page, rows: Column, p: Mapping) -> Column:
    """H5: label values of the rows behind the one whose heading names the section."""
    heading, label = parse_selector(p["heading"])[0][-1], parse_selector(p["labels"])[0][-1]
    drops = [d.lower() for d in p.get("drop", [])]
    start = F.struct(F.lit(False).alias("inside"), F.array().cast(STRINGS).alias("values"))

    def step(acc: Column, row: Column) -> Column:
        head = F.get(page.inside(row, _matches(heading)), F.lit(0))
        opens = F.coalesce(F.contains(page.text(head, "all"), F.lit(p["contains"])), F.lit(False))
        labels = page.inside(row, _matches(label))
        if p.get("exclude"):
            labels = F.filter(labels, lambda el: ~F.contains(page.text(el), F.lit(p["exclude"])))
        values = _some(F.transform(labels, lambda el: page.text(page.following(el["pos"], p.get("target", "p")))))
        values = F.filter(values, lambda v: (v != "") & ~F.lower(v).isin(drops or [""]))
        here = F.struct(F.lit(True).alias("inside"), F.concat(acc["values"], values).alias("values"))
        opened = F.struct(F.lit(True).alias("inside"), acc["values"].alias("values"))
        return F.when(opens, opened).when(acc["inside"], here).otherwise(acc)

    return F.array_sort(F.array_distinct(F.aggregate(rows, start, step)["values"]))


def section_text(page: Page, heads: Column, p: Mapping) -> Column:
    """H6: collected siblings behind each heading with a keyword, up to the next heading, as one text.

    A fold over the events behind the heading carries the depth; it closes at a
    stop element with text or where the parent ends.
    """
    def named(el: Column) -> Column:
        low = F.lower(page.text(el))
        hit = F.lit(False)
        for k in p["keywords"]:
            hit = hit | F.contains(low, F.lit(k))
        return hit

    def behind(el: Column) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("closed"), F.array().cast("array<int>").alias("found"))
        later = F.filter(page.events, lambda x: x["pos"] > el["end"])

        def step(acc: Column, x: Column) -> Column:
            sibling = x["open"] & (acc["depth"] == 0) & ~acc["closed"]
            said = F.when(sibling & x["tag"].isin(*p["stop"], p["collect"]), page.text(page._element(x)) != "").otherwise(False)
            return _let(said, lambda has_text: settle(acc, x, sibling, has_text))

        def settle(acc: Column, x: Column, sibling: Column, said: Column) -> Column:
            closed = acc["closed"] | (~x["open"] & (acc["depth"] == 0)) | (sibling & said & x["tag"].isin(*p["stop"]))
            found = F.when(sibling & said & (x["tag"] == p["collect"]) & ~closed, F.concat(acc["found"], F.array(x["pos"]))).otherwise(acc["found"])
            depth = acc["depth"] + F.when(x["tag"].isin(*VOID), 0).when(x["open"], 1).otherwise(-1)
            return F.when(acc["closed"], acc).otherwise(F.struct(depth.alias("depth"), closed.alias("closed"), found.alias("found")))

        return F.aggregate(later, start, step)["found"]

    places = F.flatten(F.transform(F.filter(heads, named), behind))
    texts = F.transform(places, lambda i: page.text(page._element(F.element_at(page.events, i))))
    return F.filter(_as_list(F.array_join(texts, "\n")), lambda t: t != "")


def _nth_following(page: Page, anchors: Column, p: Mapping) -> Column:
    """H7: the nth target behind the first anchor, or the nth of those next to each anchor."""
    n = p.get("n", 1)
    if not p.get("each"):
        el = page.following(F.get(anchors, F.lit(0))["pos"], p["target"], n)
    else:
        each = _some(F.transform(anchors, lambda a: page.following_at(a["pos"], p["target"], p["each"])["pos"]))
        event = F.element_at(page.events, F.get(F.array_sort(F.array_distinct(each)), F.lit(n - 1)))
        el = _let(event, lambda e: F.when(e.isNotNull(), page._element(e)))  # the search is not worked out again at each event
    return _as_list(page.text(el, "raw"))


def _rule(page: Page, kind: str, nodes: Column, p: Mapping, html: Column) -> Column:
    if kind == "script":
        return _as_list(ph.jsonld_block(html))
    if kind == "following":
        return _nth_following(page, nodes, p)
    if kind == "label_next":
        return label_values(page, nodes, p["contains"], p.get("target", "p"))
    if kind == "section_values":
        return section_values(page, nodes, p)
    if kind == "section_text":
        return section_text(page, nodes, p)
    if p.get("has_text"):
        nodes = F.filter(nodes, lambda el: F.contains(F.lower(page.text(el, "all")), F.lit(p["has_text"].lower())))
    first = F.get(nodes, F.lit(p.get("nth", 0)))
    if kind == "exists":
        return F.when(F.size(nodes) > 0, F.array(F.lit("1"))).otherwise(F.array().cast(STRINGS))
    if kind == "attrs":
        return _some(F.transform(nodes, lambda el: attribute(el, p["attr"])))
    if kind == "texts":
        texts = F.transform(nodes, lambda el: page.text(el, p.get("mode", "strip")))
        return texts if p.get("keep_blank") else F.filter(texts, lambda t: t != "")
    if kind == "first_string":
        return _as_list(strip(F.get(F.filter(F.flatten(F.transform(nodes, page.parts)), lambda t: t != ""), F.lit(0))))
    if kind == "text":
        return _let(first, lambda el: F.when(el.isNotNull(), F.array(page.text(el, p.get("mode", "strip")))).otherwise(F.array().cast(STRINGS)))
    if kind == "attr":
        return _as_list(attribute(first, p["attr"]))
    if kind == "strings":
        return F.when(first.isNotNull(), page.strings(first)).otherwise(F.array().cast(STRINGS))
    raise ValueError(f"unknown rule kind {kind!r}")


def _or_text(value: Column, page: Page, other: Column) -> Column:
    """A result, or the text of another element where it is empty."""
    return _let(value, lambda v: F.when((F.size(v) > 0) | other.isNull(), v).otherwise(F.array(page.text(other))))


def _selectors(rule: Rule) -> list[str]:
    _, kind, selector, p = rule
    return [] if kind in ("page_text", "script") else [s for s in (selector, p.get("scope"), p.get("fallback"), p.get("heading"), p.get("labels")) if s]  # the last two are looked for inside rows


def split_rules(rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    """(rules that the event array runs, rules whose selectors need the tree)."""
    native, rest = [], []
    for rule in rules:
        try:
            for s in _selectors(rule):
                parse_selector(s)
            native.append(rule)
        except ValueError:
            rest.append(rule)
    return native, rest


def extract_events(pages: DataFrame, rules_by_source: Mapping[str, Sequence[Rule]], passthrough: Sequence[str] = (), repair_sources: Sequence[str] = ()) -> DataFrame:
    """``operators.extract.extract_pages`` without a Python worker; selectors that need the tree raise ValueError.

    A page fails as a value (H11): ``parse_ok`` is false and ``parse_error`` names
    the reason for a source without rules, a page without markup, and one that
    ends inside a tag.
    """
    src = pages.select(F.col("page_id").cast("long"), "source", "url", "html", *passthrough)
    df = with_events(src, out="__events")
    repair = F.col("source").isin(list(repair_sources)) if repair_sources else False
    jobs = [(source, k, rule) for source, rules in rules_by_source.items() for k, rule in enumerate(rules) if rule[1] != "page_text"]
    # elements of every chain and of its ancestors, all chains of one length in one step
    known: dict[tuple, str] = {}
    for source, _, rule in jobs:
        for selector in _selectors(rule)[: 1 + bool(rule[3].get("scope")) + bool(rule[3].get("fallback"))]:
            for chain in parse_selector(selector):
                for n in range(1, len(chain) + 1):
                    known.setdefault((source, tuple(chain[:n])), f"el_{len(known)}")
    longest = max((len(c) for _, c in known), default=0)

    def of(source: str, value: Column) -> Column:
        return F.when(F.col("source") == source, value)

    def elements(page: Page, found: dict[tuple, Column], n: int = 1) -> Column:
        if n > longest:
            return inputs(page, found)
        made = F.struct(*[of(s, page.chain(c, [found[s, c[:-1]]] if n > 1 else [])).alias(name) for (s, c), name in known.items() if len(c) == n])
        return _let(made, lambda els: elements(page, found | {key: els[name] for key, name in known.items() if len(key[1]) == n}, n + 1))

    def inputs(page: Page, found: dict[tuple, Column]) -> Column:
        def nodes_of(selector: str, source: str) -> Column:
            groups = [found[source, tuple(chain)] for chain in parse_selector(selector)]
            return groups[0] if len(groups) == 1 else F.array_sort(F.array_distinct(F.concat(*groups)))

        values = []
        for source, k, (_, kind, selector, p) in jobs:
            nodes = nodes_of(selector, source) if kind != "script" else F.lit(None)
            if p.get("scope"):
                nodes = _within(nodes, F.slice(nodes_of(p["scope"], source), p.get("scope_nth", 0) + 1, 1))
            value = _rule(page, kind, nodes, p, F.col("html"))
            if p.get("fallback"):
                value = _or_text(value, page, F.get(nodes_of(p["fallback"], source), F.lit(0)))
            values.append(of(source, value).alias(f"in_{source}_{k}"))
        return _let(F.struct(*values), named) if values else F.lit(None)

    def named(got: Column) -> Column:
        results: dict[str, dict[str, list[tuple[Column, dict]]]] = {}
        for source, k, (name, _, _, p) in jobs:
            results.setdefault(source, {}).setdefault(name, []).append((got[f"in_{source}_{k}"], p))
        out = F.lit(None)
        for source, names in results.items():
            entries = []
            for name, chain in names.items():
                value = chain[-1][0]
                for column, p in reversed(chain[:-1]):  # an empty value falls through to the next rule
                    enough = F.size(column) > 0 if p.get("exists_wins") else F.exists(column, lambda v: v != "")
                    value = F.when(enough, column).otherwise(value)
                entries += [F.lit(name), F.coalesce(value, F.array().cast(STRINGS))]
            out = F.coalesce(of(source, F.create_map(*entries)), out)
        return out

    # one look-up of the events: bound once, they are searched as they were made and never written out as a column
    searched = _let(F.col("__events"), lambda events: F.struct(
        F.coalesce(F.size(events), F.lit(0)).alias("n"), elements(Page(events, repair), {}).alias("inputs")))
    df = df.withColumn("__found", searched)
    error = F.when(~F.col("source").isin(list(rules_by_source)) | F.col("source").isNull(), F.concat(F.lit("no rules for source "), F.coalesce("source", F.lit("null"))))
    error = error.when(F.col("__found.n") <= 0, "no markup").when(F.rlike("html", F.lit(CUT_OFF)), "ends inside a tag")
    with_text = [s for s, rules in rules_by_source.items() if any(kind == "page_text" for _, kind, *_ in rules)]
    text = F.when(F.col("source").isin(with_text), ph.page_text("html")) if with_text else F.lit(None).cast("string")
    read = F.struct(error.isNull().alias("parse_ok"), error.alias("parse_error"), F.when(error.isNull(), F.col("__found.inputs")).alias("inputs"), text.alias("page_text"))
    # a generate of one row: filters on the result are not pushed below it, where they would work out the whole extraction again
    once = df.select("page_id", "source", "url", *passthrough, F.explode_outer(F.array(read)).alias("read"))
    return once.select("page_id", "source", "url", "read.*", *passthrough)
