"""Main text of pages by wrappers."""

import html
import random

import pytest

from lendmart.llm import wrappers
from lendmart.llm.wrappers import Element, Text, align, dump, extract, fold, load, parse

PAGES = "page_id long, url string, html string"


def main(spark, pages, url="http://a.example/{}"):
    df = spark.createDataFrame([(i, url.format(i), p) for i, p in enumerate(pages)], PAGES)
    return [r["text"] for r in sorted(extract(df).collect(), key=lambda r: r["page_id"])]


def shape(page):
    return dump(fold(parse(page)[0]))[0]


def test_page_parts(spark):
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head>
<body class="nav-open"><header><a href="/">Site</a></header>
<div class='cookie-notice'>We use cookies</div><nav><ul><li><a href=x>Menu</a></ul></nav>
<main><article class="post"><header class="entry-header"><h1>Title &eacute;</h1></header>
<p title="a > b">One <b>tw</b>o<br>three &nbsp; x<p>Four &lt;x&gt; a < b &amp;amp; <!-- c > --></p>
<aside>Related</aside><form>Mail <input> <button>Go</button></form>
<div class="ad">Buy</div><span hidden>secret</span><script>if (a<b) "</p>"</script>
<ul><li>i1<li>i2 <i>in</i></ul><table><tr><td>c1<td>c2</table>
<section id="comments"><article class="comment">Nice!</article></section></article></main>
<aside class="sidebar">side</aside><footer>foot</footer></body>"""
    assert main(spark, [page]) == [
        "Title é One two three x Four <x> a < b &amp; i1 i2 in c1 c2"]


def test_regions_without_article(spark):
    assert main(spark, ["<main>M<div class=share>s</div></main><p>out"] * 2) == ["M"] * 2
    assert main(spark, ["<div class='post-body'>B</div><p>out"]) == ["B"]


def test_slots_are_told_from_constants(spark):
    """Pages without any naming element: the template is what never differs."""
    pages = [f"""<div id=top><a href=1>Home</a></div><div><h2>Head {i}</h2><p>Text {i}</p>
<p>More {i * i}</p></div><div>Made by the same hand</div>{'<p>tail %d' % i * (i % 2)}"""
             for i in range(6)]
    got = main(spark, pages)
    assert got == [f"Head {i} Text {i} More {i * i}" + f" tail {i}" * (i % 2) for i in range(6)]
    # alone, a page has no constants; its links go all the same
    assert main(spark, pages[:1]) == ["Head 0 Text 0 More 0 Made by the same hand"]
    # hosts do not mix
    assert main(spark, pages, "http://h{}.example/")[2].endswith("Made by the same hand")


def test_repeated_copies_of_one_page_keep_their_text(spark):
    assert main(spark, ["<p>same text<p>and more"] * 5) == ["same text and more"] * 5


def test_repeats_and_optionals():
    assert shape("<ul><li>a<li>b<li><b>c</b></ul>") == shape("<ul><li>x</li><li>y</li></ul>")
    assert '"(h2|p)","+"' in shape("<h2>1</h2><p>a<p>b<h2>2</h2><p>c<h2>3</h2><p>d")
    one, two = (fold(parse(p)[0]) for p in ("<div><h1>t</h1><p>a</div>", "<div><p>b<hr></div>"))
    both = Element("page", align(one.children, two.children))
    assert dump(both)[0] == '["page","",["div","",["h1","?","T"],["p","","T"]]]'
    assert load(*dump(both), [1, 2]).children[0].children[0].optional
    keys = dump(both)[1]
    assert keys[0] is not None and keys[1] is None


def test_long_lists_align_like_short_ones(monkeypatch):
    rng = random.Random(3)
    a, b = ([Text(rng.choice("xyz")) for _ in range(30)] for _ in range(2))
    best = wrappers.matches(a, b)
    monkeypatch.setattr(wrappers, "LONG", 1)
    found = wrappers.matches(a, b)
    assert all(a[i].label == b[j].label for i, j in found)
    assert found == sorted(found) and len(found) <= len(best)


@pytest.mark.parametrize("fan", [2, 3])
def test_rounds_of_merging_give_one_wrapper(spark, fan):
    rng = random.Random(1)
    rows = [(i, "h", "".join(f"<{t}>{rng.random()}</{t}>" for t in ("h1", "p", "h3", "dl")
                             if rng.random() < .6)) for i in range(30)]
    df = spark.createDataFrame(rows, "i long, host string, html string")
    found = wrappers.structures(df)
    formed = wrappers.wrappers(found, fan).collect()
    assert len(formed) == 1 and max(formed[0]["counts"]) > 10
    assert sum(formed[0]["counts"]) == sum(r[2].count("</") for r in rows)
    again = wrappers.wrappers(wrappers.structures(df.repartition(7)), fan).collect()
    assert again == formed


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "x", " \n"), (4, "http://A.b:80/c", "plain &amp text"),
            (4, "http://A.b:80/c", "plain &amp text"), (None, "http://u@a.b/", "<p>a <b"),
            (5, "//a.b", "<" * 50 + "x"), (6, "http://a.b", "<article>" + "<div>" * 3000 + "deep"),
            (7, "http://a.b", "<article>" + "<p>w &lt;" * 20000), (8, "q", "<a \"" * 3000),
            (9, "q", "</p></div><!-- "), (10, "q", "<script>x"), (11, "q", "<nav>only menu</nav>")]
    df = spark.createDataFrame(rows, PAGES).selectExpr(
        "*", "1 AS text", "'y' AS host", "3 AS sid", "'m' AS mask", "4 AS c0")
    out = extract(df)
    assert out.columns == ["page_id", "url", "text", "host", "sid", "mask", "c0", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert [texts[i] for i in (1, 2, 3, 9, 10, 11)] == [""] * 6
    assert texts[4] == "plain & text" and texts[None] == "a" and texts[6] == "deep"
    assert texts[7] == " ".join(["w <"] * 20000)
    assert all(r["n_chars"] == len(r["text"]) and r["host"] == "y" for r in got)
    assert extract(df.limit(0)).count() == 0


def test_hosts(spark):
    df = spark.createDataFrame([(None,), ("http://U:p@Ab.c:80/x",), ("//q.r?z",), ("rel/x",)], "u string")
    assert [r[0] for r in df.select(wrappers.host_of(df["u"])).collect()] == ["", "ab.c", "q.r", ""]


def test_references_are_decoded_once():
    assert parse("&amp;lt; &#233; &amp &bogus;")[1] == [html.unescape("&amp;lt; &#233; &amp &bogus;")]
