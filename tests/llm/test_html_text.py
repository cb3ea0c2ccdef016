import html as entities
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import SF_SMALL
from lakeops.llm import html_text as module
from lakeops.llm.html_text import Labeller, Paths, blocks_of, chains, extract, op11, padded, teacher, train, train_labeller

SCHEMA = "page_id bigint, url string, html string"


def texts(page):
    return [b.text for b in blocks_of(page, Paths())]


def template_text(page):
    """The article of the test tables' pages, which have one layout."""
    found = re.search("<article>(.*)</article>", page or "", re.S)
    parts = re.split("</?(?:p|h1)>", found[1]) if found else []
    parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
    return "\n".join(p for p in parts if p)


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))


def test_the_query_finds_each_article_of_the_table(spark):
    want = {r["page_id"]: (r["url"], template_text(r["html"])) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = op11(spark, SF_SMALL)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
<div id="cookie-notice"><p>We use cookies to make this site work. Do you accept them?</p></div>
<header><a href="/">The site</a></header><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>
<aside class="sidebar"><h3>Popular</h3><p>Some prose stands here and reads like an article of its own.</p></aside>
<{0}><h1>A  title</h1><p>First paragraph,<br>with <b>bold</b>&nbsp;words &amp; more.<p>Second one &lt;here&gt;.
<div class="advert">Buy this now, it is cheap.</div><p>A third paragraph ends the article.</p>
<section class="comments"><div class="comment"><p>I liked reading this, thank you.</p></div></section></{1}>
<form action="/"><label>Your name</label><textarea>write</textarea><button>Send</button></form>
<script>var a = "<p>no</p>";</script><!-- <p>no</p> --><footer>&copy; 2024 The site</footer></body></html>"""


@pytest.mark.parametrize("container", ["article", "main", 'div class="post-content"'])
def test_other_layouts(spark, model, container):
    """Layouts that no page of the table has."""
    page = PAGE.replace("{0}", container).replace("{1}", container.split()[0])
    df = spark.createDataFrame([(1, None, page)], SCHEMA)
    assert extract(df, model).first()["text"].split("\n") == [
        "A title", "First paragraph, with bold words & more.", "Second one <here>.", "A third paragraph ends the article."]


def test_blocks():
    assert texts("a<b>b</b> c<div>d</div>e") == ["ab c", "d", "e"]
    assert texts("<p>a<p>b</p>c") == ["a", "b", "c"]
    assert texts('<a title="x > y">l</a>ink') == ["link"]
    assert texts("1 < 2 & 3 <4") == ["1 < 2 & 3 <4"]
    assert texts("a<!-- x") == ["a"] and texts("a<!-->b") == ["ab"] and texts("<script>a</SCRIPT >b") == ["b"]
    assert texts("<textarea>a<p>b</textarea>c") == ["c"] and texts("a<br/>b<wbr>c") == ["a bc"]
    assert texts("") == [] and texts("<") == [] and texts("x<") == ["x"] and texts("<p") == [] and texts("</p>x</div>") == ["x"]
    paths = Paths()
    tree = chains(paths)
    blocks = blocks_of('<ul class="menu big"><li id=x>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>', paths)
    tree = [[t[0] for t in chains(paths)[b.path]] for b in blocks]
    assert tree == [["ul", "li"], ["ul", "li"], ["ul", "li", "ul", "li"], *[["table", "tr", "td"]] * 3]
    assert teacher(chains(paths)[blocks[0].path]) == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='a'>", "</div>", "<a href=x>", "</a>", "<", ">", "x", " ", "&amp", "'", '"', "<li>",
                                 "<!--", "-->", "<script>", "</script>", "<td>", "</table>", "<button/>", "</", "<table>"]), max_size=40))
def test_any_soup_is_read(parts):
    found = texts("".join(parts))
    assert all(t == " ".join(t.split()) and t for t in found)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = Labeller(rng)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, mask = padded([rng.normal(size=(n, module.PATH + module.WORD + module.MEASURES)) for n in (4, 2)])
    y = np.array([[1, 0], [0, 1], [-1, 0], [1, 0]], float)
    _, slopes = model.gradients(x.astype(float), mask.astype(float), y)
    for name, slope in slopes.items():
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        ends = []
        for d in (1e-4, -1e-4):
            model.weights[name][at] += d
            ends.append(model.gradients(x.astype(float), mask.astype(float), y)[0])
            model.weights[name][at] -= d
        assert slope[at] == pytest.approx((ends[0] - ends[1]) / 2e-4, rel=2e-2, abs=1e-5)


def test_held_out_layouts():
    """Labels of layouts, and of texts, that training hasn't seen."""
    filler = [[(f"Some words {i} {k} of an article, which go on for a while.", 1) for k in range(8)] + [("Imprint", 0)] for i in range(60)]
    pages = ["<article>" + "".join(f"<p>{t}</p>" for t, _ in p[:-1]) + "</article><footer>Imprint</footer>" for p in filler[:30]]
    model, paths = train_labeller(pages), Paths()
    made = module.Layouts(filler[30:], 99)
    fresh = [made.page(paths) for _ in range(300)]
    scores = model.scores([[b for b, _ in p] for p in fresh], paths)
    right = [(s >= 0.5) == label for p, r in zip(fresh, scores) for (_, label), s in zip(p, r)]
    assert np.mean(right) > 0.97


def test_long_pages_go_part_by_part(model, monkeypatch):
    page = "<nav><a>x</a></nav><article>" + "".join(f"<p>Paragraph {i} has some words.</p>" for i in range(700)) + "</article><footer>y</footer>"
    paths = Paths()
    blocks = blocks_of(page, paths)
    whole = model.scores([blocks], paths)[0]
    monkeypatch.setattr(module, "STEP_BLOCKS", 64)
    assert np.allclose(model.scores([blocks], paths)[0], whole, atol=1e-4)


def test_odd_pages(spark, model):
    long = "<article>" + "<p>Some words in a long page.</p>" * 100_000 + "<p>" + "word " * 1_000_000 + "</p></article>"
    pages = [(1, "u", None), (1, "u", ""), (None, None, "<article><p>One text.</p><p>Two of them.</p></article>"), (2, "v", "<" * 50_000),
             (3, "w", "<div>" * 50_000 + "deep"), (4, "w", '<a b="' * 20_000), (5, "x", long), (5, "x", long), (6, None, "<script>x")]
    df = spark.createDataFrame([(*p, "n", "m") for p in pages], SCHEMA + ", text string, n_blocks string")
    got = sorted(((r["page_id"] or 0, r["text"]) for r in extract(df, model).collect()))
    assert [k for k, _ in got] == [0, 1, 1, 2, 3, 4, 5, 5, 6]
    assert got[0][1] == "One text.\nTwo of them." and got[1][1] == got[2][1] == "" == got[8][1]
    assert got[6][1] == got[7][1] == template_text(long)
    none = spark.createDataFrame([], SCHEMA)
    assert train(none) is None and extract(none, None).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, None, "<p> </p>")], SCHEMA)
    assert [r["text"] for r in extract(blank, train(blank)).collect()] == ["", ""]
