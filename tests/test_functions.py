"""Unit tests for column expressions; expected values follow Python ``str``
semantics and are written by hand."""

from pyspark.sql import functions as F

from postlake import functions as pf
from postlake.functions import html as ph
from postlake.rules.locations import PROVINCE_RULES, REMOTE_WORDS


def one_col(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]


def test_strip_unicode_whitespace(spark):
    vals = ["\t hola ", "  a b  ", "x", "", None, " y\n"]
    assert one_col(spark, vals, pf.strip) == [v.strip() if v is not None else None for v in vals]


def test_title_case_matches_python(spark):
    vals = ["it's o'neil c++/java", "ßa straße", "ÉCOLE élan", "c3po abc", "", None, "data ANALYST sr.", "漢a b漢c", "ªb ⅷx", "ʰa 1ºb"]
    assert one_col(spark, vals, pf.title_case) == [v.title() if v is not None else None for v in vals]


def test_remove_noise_and_punct(spark):
    got = one_col(spark, ["córdoba, capital!!  (ar)"], pf.remove_noise)
    assert got == ["córdoba capital ar "]
    assert one_col(spark, ["¡Hola, señor! it's 3.5"], pf.remove_punct) == ["Hola señor its 35"]


def test_tokens_and_first_words(spark):
    assert one_col(spark, ["  Data   Analyst\tSR  ", ""], pf.tokens) == [["Data", "Analyst", "SR"], []]
    assert one_col(spark, ["Senior Data Engineer Python AWS Remote", "One", None], lambda c: pf.first_words(c, 5)) == [
        "senior data engineer python aws",
        "one",
        None,
    ]
    assert one_col(spark, ["a b", None], lambda c: pf.first_words(c, 0)) == ["", None]


def test_first_int_and_date(spark):
    assert one_col(spark, ["12 postulantes", "sin datos", None, "Customer#000000042", "99999999999"], pf.first_int) == [
        12, None, None, 42, None,
    ]
    assert one_col(spark, ["Publicado 3/4/2024 hoy", "12/345", None, "x 31/12/2023"], pf.first_date) == [
        "3/4/2024", None, None, "31/12/2023",
    ]


def test_split_last(spark):
    def both(c):
        h, t = pf.split_last(c, " - ")
        return F.struct(h.alias("h"), t.alias("t"))

    got = [tuple(r) if r else None for r in one_col(spark, ["Grupo Metropol - San Nicolás, Capital Federal", "A - B - C", "Solo Empresa ", "x - - b"], both)]
    assert got == [("Grupo Metropol", "San Nicolás, Capital Federal"), ("A - B", "C"), ("Solo Empresa", None), ("x", "- b")]


def test_first_nonempty(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(pf.first_nonempty("a", "b")).collect()] == ["b", "b", "a", ""]


def test_job_key_matches_hashlib(spark):
    import hashlib

    df = spark.createDataFrame([("http://x/1", "Data Analyst", "ACME"), ("http://x/2", None, None)], "u string, t string, c string")
    got = [r[0] for r in df.select(pf.job_key("u", "t", "c")).collect()]
    exp = [hashlib.sha256(s.encode()).hexdigest()[:20] for s in ["http://x/1Data AnalystACME", "http://x/2"]]
    assert got == exp


def test_urls(spark):
    df = spark.createDataFrame(
        [("/empleos/1", "https://www.getonbrd.com/"), ("http://a/b", "https://z"), ("", "https://z"), (None, "https://z"), ("//x", "https://z//")],
        "h string, b string",
    )
    got = [r[0] for r in df.select(pf.absolute_url("h", F.col("b"))).collect()]
    assert got == ["https://www.getonbrd.com/empleos/1", "http://a/b", None, None, "https://z/x"]
    u = spark.createDataFrame([("https://ar.indeed.com/rc/clk?jk=ab12&from=x",), ("https://ar.indeed.com/other",)], "u string")
    got = [r[0] for r in u.select(pf.canonical_by_param("u", "https://ar.indeed.com")).collect()]
    assert got == ["https://ar.indeed.com/viewjob?jk=ab12", "https://ar.indeed.com/other"]
    assert one_col(spark, ["Data Analyst Sr", "Ñandú & co"], pf.safe_name) == ["Data_Analyst_Sr", "_and____co"]
    assert one_col(spark, ["Data Analyst"], pf.slug) == ["data-analyst"]
    assert one_col(spark, ["Portal Empleo"], pf.site_key) == ["portal_empleo"]


def test_modality_and_region(spark):
    from postlake.rules.sites import MODALITY_RULES

    vals = ["Trabajo REMOTO", "Híbrido", "hybrid work", "Presencial", "otro", None]
    got = one_col(spark, vals, lambda c: pf.classify_contains(c, MODALITY_RULES, "Otros"))
    assert got == ["Remoto", "Híbrido", "Híbrido", "Presencial", "Otros", "Otros"]
    locs = ["Remoto, Córdoba", "Caballito, CABA", "Rosario, Santa Fe", "Villa Mercedes", "Springfield 123", None, "córdoba capital"]
    got = one_col(spark, locs, lambda c: pf.normalize_region(c, PROVINCE_RULES, REMOTE_WORDS))
    assert got == ["remote", "buenos aires", "santa fe", "san luis", "springfield ", None, "cordoba"]


def test_lists(spark):
    df = spark.createDataFrame([(["  SQL", "", "no", "Python "], ["sql", "SQL"]), ([], None)], "a array<string>, b array<string>")
    got = [r[0] for r in df.select(pf.set_union(pf.clean_list("a", ["no"]), "b")).collect()]
    assert got == [["Python", "SQL", "sql"], []]
    got = [r[0] for r in df.select(pf.join_lines("a")).collect()]
    assert got == ["  SQL\n\nno\nPython ", None]
    got = [r[0] for r in df.select(pf.first_matching("a", ["pyth"])).collect()]
    assert got == ["Python ", None]
    got = [r[0] for r in df.select(pf.any_contains("a", ["SQL"])).collect()]
    assert got == [True, False]


def test_range_and_flag(spark):
    df = spark.createDataFrame([("100", "200", "Sueldo A CONVENIR"), ("100", None, "fijo")], "a string, b string, t string")
    assert [r[0] for r in df.select(pf.range_string("a", "b")).collect()] == ["100 - 200", None]
    assert [r[0] for r in df.select(pf.flag_phrase("t", "a convenir", "A Convenir")).collect()] == ["A Convenir", None]


def test_html_flat_reads(spark):
    html = (
        '<html><head><script>var t="<h1>no</h1>";</script><!-- <h1>no</h1> -->'
        '<script type="application/ld+json">{"title": "T1", "hiringOrganization": {"name": "Org"}}</script></head>'
        '<body><h1 class="x"> Data <b>Eng</b> &amp; Co </h1><a href="/a?x=1&amp;y=2">A</a><a href="https://h/b">B</a>'
        "<p>Publicado 1/2/2024</p></body></html>"
    )
    df = spark.createDataFrame([(html,), ("<html><body>Access Denied</body></html>",)], "h string")
    r = df.select(
        ph.first_tag_text("h").alias("t"), ph.hrefs("h").alias("l"), ph.is_blocked("h", ["access denied"]).alias("b"),
        ph.jsonld_value(ph.jsonld_block("h")).alias("ld"),
    ).select("*", ph.jsonld_get("ld", "title").alias("lt"), ph.jsonld_get("ld", "company").alias("lc")).collect()
    assert r[0]["t"] == "DataEng& Co"  # get_text(strip=True): stripped nodes joined with nothing
    assert r[0]["l"] == ["/a?x=1&y=2", "https://h/b"]
    assert r[0]["b"] is False and r[1]["b"] is True
    assert r[0]["lt"] == "T1" and r[0]["lc"] == "Org"
    assert r[1]["t"] is None and r[1]["ld"] is None


def test_page_text_and_run_date(spark):
    import datetime

    html = "<html><head><style>p{}</style><script>x=1</script></head><body><!-- c --><p>Hola &amp; <b>chau</b></p>12/3/2024</body></html>"
    df = spark.createDataFrame([(html,)], "h string")
    r = df.select(ph.page_text("h").alias("t"), pf.first_date(ph.page_text("h")).alias("d"), pf.today_ds().alias("ds")).first()
    assert r.t.split() == ["Hola", "&", "chau12/3/2024"]
    assert r.d is None  # "chau12/3/2024": no word boundary before the day, as in Python's \b
    assert r.ds == datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d")


def test_every_reference_is_decoded_once(spark):
    import html as std

    vals = ["Programaci&oacute;n", "&#233;&#xE9;&#X1F600; &amp;lt; &nosuch; & &amp", "&NotEqualTilde;&nbsp;x", "plain", "", None, "&ntilde;&Ntilde;&euro;&hellip;", "&#0;&#xD800;"]
    got = one_col(spark, vals, ph.decode_entities)
    assert got[0] == "Programación" and got[1] == "éé😀 &lt; &nosuch; & &amp" and got[7] == "\ufffd\ufffd"
    for v, g in zip(vals, got):
        if v is not None and "&amp" not in v:
            assert g == std.unescape(v)


def test_hrefs_in_any_quoting(spark):
    page = """<a data-href="/no" href='/one'>1</a><A title="a > b href=x" HREF = /two >2</A><abbr href="/no2">x</abbr>
    <a class=k href="/three?a=1&amp;b=2">3</a><a name="x">none</a>"""
    assert one_col(spark, [page, None], ph.hrefs) == [["/one", "/two", "/three?a=1&b=2"], None]


def test_empty_jsonld_is_no_posting(spark):
    blocks = ["{}", "[]", "null", "{bad", '{"title": ""}', None]
    got = one_col(spark, blocks, lambda c: ph.jsonld_holds_fields(ph.jsonld_value(c)))
    assert got == [False, False, False, False, True, False]
