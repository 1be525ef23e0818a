import random
import re

import pytest

from ledgerline.llm import html_extract as X
from ledgerline.llm.html_blocks import blocks


@pytest.fixture(scope="module")
def model(spark):
    from tests.conftest import SF01
    return X.fit(spark.read.parquet(f"{SF01}/pages.parquet"))


def texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize("html, want", [
    ("", []),
    ("plain", ["plain"]),
    ("<p>a<p>b</p>c", ["a", "b", "c"]),
    ("<p>a <b>b<br>c</p> d", ["a b c", "d"]),
    ("<ul><li>x<li>y<ul><li>z</ul></ul>", ["x", "y", "z"]),
    ("<p>&lt;i&gt; &amp;amp; &eacute;&nbsp; x &am", ["<i> &amp; é x &am"]),
    ("a<!-- <p>no</p> -->b<!DOCTYPE x><?pi?>c", ["abc"]),
    ("<script>var a='<p>x</p>'</script>t<style>p{}</style><textarea>f</textarea><title>n</title>", ["t"]),
    ("<script>never closed <p>x</p>", []),
    ("<p>cut <a href='x", ["cut"]),
    ("<p>cut </", ["cut"]),
    ("1 < 2 <3", ["1 < 2 <3"]),
    ("<p title='a>b'>t</p><P CLASS=x>u", ["t", "u"]),
    ("<div>" * 3000 + "deep", ["deep"]),
    ("</p></div>x</b>", ["x"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
])
def test_blocks(html, want):
    assert texts(html) == want


def test_viterbi_is_the_best_of_all_labellings(model):
    page = blocks("<nav><a>x</a></nav><article><h1>t</h1><p>a b c.</p><div class=ad>buy</div><p>d</p></article><footer>f</footer>")
    import itertools

    def value(labels):
        f = X.features(page)
        total = model.start[labels[0]]
        for k, y in enumerate(labels):
            total += y * sum(model.weights.get(x, 0.0) for x in f[k])
            if k:
                total += model.trans[labels[k - 1]][y]
        return total

    best = max(itertools.product((0, 1), repeat=len(page)), key=value)
    assert tuple(model.decode(page)) == best


def test_held_out_layouts(spark, model):
    from tests.conftest import SF01
    sample = [r["html"] for r in spark.read.parquet(f"{SF01}/pages.parquet").limit(60).collect()]
    made = X.training_pages(sample, 400)
    crf = X.train(made[:300])
    wrong = sum(a != b for p, y in made[300:] for a, b in zip(crf.decode(p), y))
    assert wrong / sum(len(y) for _, y in made[300:]) < 0.02


def test_pages_of_the_table(spark, model):
    import html as H

    from tests.conftest import SF01
    rows = X.extract(spark.read.parquet(f"{SF01}/pages.parquet"), model).collect()

    def article(page):
        inner = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*$", "", inner).replace("<br>", " "))
        return "\n".join(t for p in parts if (t := " ".join(H.unescape(re.sub(r"<[^>]+>", "", p)).split())))

    assert sum(r["text"] == article(r["html"]) for r in rows) >= 0.98 * len(rows)


PAGE = """<html><body><div id="cookie-banner">We use cookies <button>OK</button></div><div class="menu"><a>x</a></div>
<div class="wrap"><div class="post-content"><h1>Title here</h1><p>Para one.<p>Second <i>para</i> it is.<ul><li>one<li>two</ul>
<form><input><p>Your mail</p></form></div><section class="comments"><h2>Comments</h2><div class=comment><p>I liked this a lot.</p></div></section></div>
<div class="sidebar"><h3>Popular</h3><ul><li><a>a b</a></ul></div><div class=footer>&copy; x</div></body></html>"""


def test_a_layout_without_html5_sections(model):
    assert model.main_text(PAGE) == "Title here\nPara one.\nSecond para it is.\none\ntwo"


def test_table(spark, model):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x"), (3, "u", "<p>cut", None), (4, "u", "<p>" + "word " * 300000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = X.extract(df, model).collect()
    assert len(got) == 6
    of = {r["page_id"]: r["text"] for r in got}
    assert of[2] == of[None] == "" and of[1].startswith("Title here")
    none = X.extract(df.limit(0), X.fit(df.limit(0)))
    assert none.count() == 0


def test_formulas_listings_and_elements_that_never_end():
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]
    assert texts("<p>see</p><xmp>if a<b: &amp; <p>c</xmp><p>end</p>") == ["see", "if a<b: &amp; <p>c", "end"]
    assert texts("<p>a <object data=x>a chart of it</object></p>") == ["a a chart of it"]
    assert texts("<p>a <svg><text>icon</text></svg> b</p>") == ["a b"]
    for name in ("svg", "template", "object", "math"):
        assert texts(f"<p>one <{name}></p><p>two</p>") == ["one", "two"]
    assert texts("<p>one</p><script>x = 1 <p>two</p>") == ["one"]


def test_deep_pages_take_linear_memory_and_time():
    """50,000 nested elements of distinct classes, and tags that never end."""
    import time
    import tracemalloc
    names = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(50_000)]
    deep = "".join(f'<div class="{c}">t{i}' for i, c in enumerate(names))
    crf = X.Crf({"t=div": 0.5, f"c={names[0]}": 1.0, f"c={names[-1]}": 2.0}, [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0])
    tracemalloc.start()
    page = blocks(deep)
    sums = crf.around(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(page) == 50_000 and peak < 500e6
    assert sums[0] == sums[-2] == 1.5 and sums[-1] == 3.5
    for bad in ("<svg>" * 100_000 + "text", "<template>" * 50_000 + "text", "<div>" * 50_000 + "</section>" * 50_000, "<li><ul>" + "<div>" * 50_000 + "<li></li>" * 50_000):
        at = time.monotonic()
        blocks(bad)
        assert time.monotonic() - at < 20


def test_nested_svg_and_template_leak_nothing():
    page = ("<p>a</p><svg><svg></svg><text>LEAK</text></svg><template><template><p>x</p></template><p>LEAK</p></template>"
            "<p>b</p><svg/><p>c</p><SVG><g></g></SVG ><p>d</p>")
    assert [b.text for b in blocks(page)] == ["a", "b", "c", "d"]
    assert [b.text for b in blocks("<svg><p>in</p><svg><text>x</text></svg><p>out</p>")] == ["in", "out"]


def test_weights_of_ancestors_are_those_of_all_features():
    """The running sums against the features of each block, added up."""
    from ledgerline.llm.html_blocks import PageMaker
    maker = PageMaker(["some words of a paragraph that goes on for a while."], ["home", "news"], seed=3)
    r = random.Random(1)
    for _ in range(40):
        page = blocks(maker.page())
        every = {x for f in X.features(page) for x in f}
        crf = X.Crf({x: r.uniform(-1, 1) for x in sorted(every)}, [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0])
        for b, s in zip(page, crf.around(page)):
            assert abs(s - sum(crf.weights[x] for x in b.around)) < 1e-9
