"""Selector forms and text modes of the extraction job's page tree."""

from postlake.operators.htmltree import Document

HTML = """<html><body>
<div id="main" class="a b"><p class="x">one <b>bold</b></p><span>s1</span><p>two</p>
  <div><p class="x">nested</p></div></div>
<ul><li>l1</li><li> l2 </li><li>l3</li></ul>
<a href="/empleos/ciudad/x" data-url="/perfiles/co">link</a>
<svg class="fa-map-marker-alt"></svg><span>after svg</span><text>t</text>
<script>var x = "<p>not a p</p>";</script>
<p>unclosed <p>inner</body></html>"""

DOC = Document(HTML)


def texts(sel, mode="strip"):
    return [n.text(mode) for n in DOC.select(sel)]


def test_type_class_id_and_groups():
    assert texts("p.x") == ["onebold", "nested"]
    assert texts("#main > p") == ["onebold", "two"]
    assert texts("#main p") == ["onebold", "two", "nested"]
    assert texts("div.a.b > span") == ["s1"]
    assert texts("span, li") == ["s1", "l1", "l2", "l3", "after svg"]  # document order


def test_attribute_operators():
    assert texts("a[href*='/ciudad/']") == ["link"]
    assert texts("a[href^='/empleos']") == ["link"]
    assert texts("a[href$='x']") == ["link"]
    assert texts("a[data-url*=perfiles]") == ["link"]
    assert texts("a[href='/nope']") == []
    assert texts("[data-url]") == ["link"]


def test_siblings_and_nth_of_type():
    assert texts("svg.fa-map-marker-alt ~ span") == ["after svg"]
    assert texts("svg + span") == ["after svg"]
    assert texts("svg ~ text") == ["t"]
    assert texts("ul > li:nth-of-type(2)") == ["l2"]
    assert texts("#main > p:nth-of-type(2)") == ["two"]


def test_text_modes_and_hidden_text():
    li = DOC.select("li")[1]
    assert li.text("strip") == "l2" and li.text("all") == " l2 " and li.text("raw") == "l2"
    assert DOC.select_one("p.x").text("newline") == "one\nbold"
    assert DOC.select_one("p.x").stripped_strings() == ["one", "bold"]
    assert "not a p" not in DOC.text("all")
    assert DOC.select_one("script").raw_text() == 'var x = "<p>not a p</p>";'
    # unclosed <p> nests the next one (no implicit close)
    assert texts("p")[-2:] == ["unclosedinner", "inner"]


def test_following_and_find_next():
    anchor = DOC.select_one("svg")
    assert [n.tag for n in DOC.following(anchor, "span")] == ["span"]
    first_p = DOC.select_one("p.x")
    assert DOC.find_next(first_p, "b").text() == "bold"  # descendants count for find_next
    assert [n.text() for n in DOC.following(first_p, "p")][:1] == ["two"]  # not its own descendants


def test_wide_parent_is_linear():
    import time

    html = "<ul>" + "".join(f"<li>i{i}</li>" for i in range(20000)) + "</ul>"
    t0 = time.time()
    doc = Document(html)
    assert doc.select("li:nth-of-type(20000)")[0].text() == "i19999"
    assert time.time() - t0 < 10


def test_repair_mode_implicit_end_tags():
    html = "<body><p>one<div>block</div><p>two<p>three<ul><li>a<li>b</ul><h2>x<h2>y</h2><dl><dt>k<dd>v<dt>k2</dl></body>"
    plain = Document(html)
    fixed = Document(html, repair=True)
    assert [n.text() for n in plain.select("p")][0] == "oneblocktwothreeabxyk" "vk2"
    assert [n.text() for n in fixed.select("p")] == ["one", "two", "three"]
    assert [n.text() for n in fixed.select("ul > li")] == ["a", "b"]
    assert [n.text() for n in fixed.select("h2")] == ["x", "y"]
    assert [n.text() for n in fixed.select("dl > dt")] == ["k", "k2"] and fixed.select_one("dd").text() == "v"
    assert [n.text() for n in fixed.select("div")] == ["block"]
