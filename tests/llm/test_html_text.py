"""Rendering of small pages, and all visible words of the given ones."""

import html
import re
from random import Random

from faregauge.llm.html_text import extracted, page_text

SF = "/root/testdata/sf0.01"


def test_blocks_lists_and_tables():
    page = """<title>no</title><h1>Head</h1><p>one <b>two</b>
      three<p>next<br>line<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>
      <table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>s<td>22</table><pre>  a
   b</pre>tail<div>d1</div><div>d2</div>"""
    assert page_text(page).split("\n") == [
        "Head", "", "one two three", "", "next", "line", "", "- a", "- b", "", "  3. x", "  4. y", "",
        "name       n", "long name  1", "s          22", "", "  a", "   b", "", "tail", "d1", "d2",
    ]


def test_hidden_text_is_left_out():
    page = """<style>.x, #y {display:none} em{color:red}</style><p hidden>1<p style="DISPLAY : none">2<p class="a x">3
    <p id=y>4<script>5</script><template>6</template><!-- 7 --><p>8 <em>9</em><span style="visibility:hidden">10</span></p>"""
    assert page_text(page) == "8 9"


def test_heads_without_an_end():
    assert page_text("<head><title>T</title><p>text") == "text"
    assert page_text("<html><head><meta charset=x><title>T</title>plain <b>text</b>") == "plain text"
    assert page_text("<head>\n<style>.x{display:none}</style>\n<script>s</script><div class=x>1</div>2") == "2"
    assert page_text("<head><noscript><link rel=x></noscript><title>T</title><ul><li>a") == "- a"
    assert page_text("<head><title>T</title></head><p>text") == page_text("<head><title>T</title><body><p>text") == "text"
    assert page_text("<header>shown</header>") == "shown"


def test_drawings_formulas_and_fallbacks_are_shown():
    assert page_text("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> b") == "a x=1 b"
    assert page_text("<svg><title>no</title><defs><text>no</text></defs><text>yes</text></svg>") == "yes"
    assert page_text("<object data=x><p>instead</p></object>") == "instead"


def test_broken_and_odd_pages():
    assert page_text(None) == page_text("") == page_text("<p></p><script>x") == ""
    assert page_text("a </b> b < c &amp; &lt;d&gt; &nbsp;e") == "a b < c & <d>  e"
    assert page_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert page_text("<table><tr><td>a<table><tr><td>b</table>c<td>d</table>").split() == ["a", "d", "b", "c"]
    assert page_text("<table>out<tr>stray<td>in</table>").split("\n") == ["out", "stray", "in"]
    assert len(page_text("<p>" + "word " * 300_000).split()) == 300_000
    assert page_text("<ul><li>1<ul><li>2</ul><li>3</ul>").split("\n") == ["- 1", "", "  - 2", "- 3"]


def test_all_visible_words_of_the_table(spark, make):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in extracted(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"(?s)<!--.*?-->|<head.*?</head>|<(script|style|template|title)\b.*?</\1>", " ", r.html)
        hidden = re.search(r"hidden|display\s*:\s*none", body)
        words = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        shown = [w for w in got[r.page_id].split() if w not in ("-", "---", ">") and not re.fullmatch(r"\d+\.", w)]
        if not hidden:
            letters = re.sub(r"[\s>-]|\d+\.", "", "".join(words))
            assert sorted(re.sub(r"[\s>-]|\d+\.", "", "".join(shown))) == sorted(letters)
    odd = make([(1, None, "u"), (None, "<p>x", "u"), (1, "", "u")], "page_id long, html string, text string")
    assert sorted(map(str, (tuple(r) for r in extracted(odd).collect()))) == ["(1, '')", "(1, '')", "(None, 'x')"]
    assert extracted(odd.limit(0)).collect() == []


def test_depth_has_no_limit():
    for depth in (148, 152, 20_000):
        nest = "<div>" * depth
        assert page_text(nest + "<div hidden><p>secret</p></div>after") == "after"
        assert page_text(nest + "<style>.x{color:red}</style><script>s</script>text") == "text"
    assert page_text("<b>" * 5000 + "x<ul>" + "<li><ul>" * 300 + "<li>deep").split()[-1] == "deep"
    assert page_text("<table><tr><td>" * 2000 + "cell") == "cell"
    assert page_text("<p>" + "<div><p>a" * 3000).split() == ["a"] * 3000


def test_media_and_the_order_of_rules():
    assert page_text("<style>@media print {.x{display:none}}</style><p class=x>t") == "t"
    assert page_text("<style media=print>.x{display:none}</style><p class=x>t") == "t"
    assert page_text("<style>@media only screen, print {.x{display:none}} .y{color:red}</style><p class=x>t<p>u") == "u"
    assert page_text("<style>@media (max-width:9px) {.x{display:none}}</style><p class=x>t") == "t"
    assert page_text("<style>@media print{a{b:c} .x{display:none}} .y{display:none}</style><p class=x>t<p class=y>u") == "t"
    assert page_text("<style>.x{display:none} .x{display:block}</style><p class=x>t") == "t"
    assert page_text("<style>#i{display:block} .x{display:none}</style><p class=x id=i>t") == "t"
    assert page_text("<style>.x{display:none !important} .x{display:block}</style><p class=x style='display:block'>t") == ""
    assert page_text("<style>.x{display:none}</style><p class=x style='display:block'>t") == "t"
    assert page_text("<style>/* .x{display:none} */ @import 'a.css'; .y{display:none}</style><p class=x>t<p class=y>u") == "t"
    assert page_text("<style>.x{color:red;display:none;top:0}</style><p class=x>t") == ""


def test_selectors():
    sheet = "<style>div.ad{display:none} .a .b{display:none} ul > li.c{display:none} [data-k=v]{display:none} p:hover{display:none}</style>"
    assert page_text(sheet + "<div class='ad x'>1</div><p class=ad>2</p>") == "2"
    assert page_text(sheet + "<div class=a><p>3<i class=b>4</i></p></div><i class=b>5</i>") == "3\n\n5"
    assert page_text(sheet + "<ul><li class=c>6<li>7<ol><li class=c>8</ol></ul>").split() == ["-", "7", "1.", "8"]
    assert page_text(sheet + "<p data-k=v>9<p data-k=w>10") == "10"
    assert page_text("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"
    many = "<style>.none div{display:none}</style>" + "<div>" * 20_000 + "shown"
    assert page_text(many) == "shown"


def test_visibility_is_inherited_and_may_return():
    page = "<div style='visibility:hidden'>a<p>b<p style='visibility:visible'>c<hr></div>d"
    assert page_text(page).split() == ["c", "d"]  # the rule ends the paragraph
    assert page_text("x<span style='visibility:hidden'>y</span>z") == "x z"
    assert page_text("<ul><li style='visibility:hidden'>a<li>b</ul>") == "- b"
    assert page_text("<div style='display:none'><p style='display:block;visibility:visible'>a</div>b") == "b"


def placed(rows):
    """Columns of cells by trying all places in turn: (text, columns, rows) per cell."""
    full, found = {}, {}
    for r, row in enumerate(rows):
        c = 0
        for text, wide, high in row:
            while (r, c) in full:
                c += 1
            found[text] = c
            full |= {(i, j): text for i in range(r, min(r + high, len(rows))) for j in range(c, c + wide)}
            c += wide
    return found


def test_cells_that_span_rows():
    assert page_text("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>").split("\n") == ["A  B", "   C"]
    groups = "<table><tbody><tr><td rowspan=0>A<td>B<tr><td>C</tbody><tbody><tr><td>D<td>E</table>"
    assert page_text(groups).split("\n") == ["A  B", "   C", "D  E"]
    assert page_text("<table><tr><td colspan=9999999>A<td>B</table>") == "A  B"
    random = Random(7)
    for _ in range(200):
        names = iter(range(10, 99))
        rows = [
            [(str(next(names)), random.randint(1, 3), random.randint(1, 3)) for _ in range(random.randint(1, 4))]
            for _ in range(random.randint(1, 4))
        ]
        body = "".join(
            "<tr>" + "".join(f"<td colspan={w} rowspan={h}>{t}" for t, w, h in row) for row in rows
        )
        columns = placed(rows)
        order = sorted(set(columns.values()))
        lines = page_text(f"<table>{body}</table>").split("\n")
        for line, row in zip(lines, rows, strict=True):
            for text, _, _ in row:
                assert line[order.index(columns[text]) * 4 :].startswith(text)
