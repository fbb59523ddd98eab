"""Property test: the text expressions agree with Python ``str`` semantics
on generated strings (letters with accents, ß, digits, punctuation and every
kind of whitespace the pages can carry)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlake import functions as pf

ALPHABET = list("abcXYZéÉñÑßüÖçÇíó09_-.,;:!?'\"()/#&+ ") + ["\t", "\n", "\r", "\x0b", "\x0c", "\xa0", " ", " ", "　", "\x85", "\x1c"]
TEXT = st.text(alphabet=ALPHABET, max_size=40)


def py_first_words(s, n):
    return " ".join(s.lower().split()[:n])


def py_remove_punct(s):
    return re.sub(r"[^\w\s]", "", s)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=150, max_size=150))
def test_text_expressions_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.orderBy("i").select(
        pf.strip("v").alias("strip"),
        pf.title_case("v").alias("title"),
        pf.tokens("v").alias("split"),
        pf.first_words("v", 3).alias("first3"),
        pf.remove_punct("v").alias("punct"),
        F.lower("v").alias("lower"),
    ).collect()
    for v, r in zip(values, rows):
        assert r["strip"] == v.strip(), repr(v)
        assert r["title"] == v.title(), repr(v)
        assert r["split"] == v.split(), repr(v)
        assert r["first3"] == py_first_words(v, 3), repr(v)
        assert r["punct"] == py_remove_punct(v), repr(v)
        assert r["lower"] == v.lower(), repr(v)


def py_noise(s):
    return re.sub(r"\s+", " ", re.sub(r"[^a-záéíóúñ\s]", " ", s))


def py_split_last(s, sep=" - "):
    parts = s.split(sep)
    if len(parts) > 1:
        return sep.join(parts[:-1]).strip(), parts[-1].strip()
    return s.strip(), None


def py_first_int(s):
    m = re.search(r"([0-9]+)", s)
    if not m:
        return None
    v = int(m.group(1))
    return v if v < 2**31 else None


def py_first_date(s):
    m = re.search(r"\b([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})\b", s)
    return m.group(1) if m else None


def py_absolute(h, base):
    if not h:
        return None
    return h if h.startswith("http") else f"{base.rstrip('/')}/{h.lstrip('/')}"


MIXED = st.text(alphabet=ALPHABET + list("-/12/3/2024 - "), max_size=40)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(MIXED, MIXED), min_size=120, max_size=120))
def test_more_expressions_match_python(spark, pairs):
    import hashlib

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    head, last = pf.split_last("a", " - ")
    rows = df.orderBy("i").select(
        pf.remove_noise(F.lower("a")).alias("noise"),
        head.alias("head"), last.alias("last"),
        pf.first_int("a").alias("int"),
        pf.first_date("a").alias("date"),
        pf.absolute_url("a", F.lit("https://site.example/")).alias("abs"),
        pf.job_key("a", "b", "a").alias("key"),
    ).collect()
    for (a, b), r in zip(pairs, rows):
        assert r["noise"] == py_noise(a.lower()), repr(a)
        assert (r["head"], r["last"]) == py_split_last(a), repr(a)
        assert r["int"] == py_first_int(a), repr(a)
        assert r["date"] == py_first_date(a), repr(a)
        assert r["abs"] == py_absolute(a, "https://site.example/"), repr(a)
        assert r["key"] == hashlib.sha256(f"{a}{b}{a}".encode()).hexdigest()[:20], repr(a)
