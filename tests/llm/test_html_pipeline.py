from __future__ import annotations

import html
import re
import tempfile
from collections import Counter

import corpus_pipeline as cp
from candlewick.llm import html_text as ht
from candlewick.llm import neardup
from candlewick.llm.queries import op4
from tests.conftest import SF001


def test_blocks_lists_and_tables():
    page = """<title>no</title><h1>Head</h1><p>one <b>two</b><p>three<br>four<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>
    <table><tr><th>k<th>value<tr><td>long key<td>1<tr><td>z<td>22</table><div style="display: none">gone</div>
    <pre>  keep
   this</pre><script>var t="</p>";</script><p hidden>gone<p>end &amp; more"""
    assert ht.text_of(page) == "\n".join([
        "Head", "", "one two", "", "three", "four", "", "- a", "- b", "  3. x", "  4. y", "",
        "k         value", "long key  1", "z         22", "", "  keep", "   this", "", "end & more",
    ])


def test_head_ends_at_any_tag_that_is_not_its_own():
    assert ht.text_of("<head><title>t</title><b>Hello</b><p>x") == "Hello\n\nx"
    assert ht.text_of("<head><meta charset=x><a href=y>link</a> <span>here</span>") == "link here"
    assert ht.text_of("<head><title>t</title><style>b</style><script>c</script><noscript><b>d</b></noscript></head>e") == "e"


def test_text_of_formulas_pictures_maps_and_choices():
    assert ht.text_of("a <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>tex</annotation></math> b") == "a x+1 b"
    svg = "<svg><title>t</title><desc>d</desc><defs><text>no</text></defs><g><text>one</text><text>two</text></g></svg>"
    assert ht.text_of(f"<p>p{svg}q") == "p\none\ntwo\nq"
    assert ht.text_of("<svg><defs/><path d='M0'/><text>seen</text></svg>") == "seen"
    assert ht.text_of("<map name=m><p>way</p><area></map>") == "way"
    options = "<option disabled>-<optgroup label=l><option>b<option{}>c</optgroup><option hidden>h"
    assert ht.text_of(f"<p>Pick <select>{options.format('')}</select> now") == "Pick b now"
    assert ht.text_of(f"<p>Pick <select>{options.format(' selected')}</select> now") == "Pick c now"
    assert ht.text_of(f"<select multiple>{options.format('')}</select>") == "-\nb\nc"


def test_what_lies_below_the_tree_keeps_its_visibility():
    deep = lambda inside, n=200: "<div>" * n + inside + "</div>" * n
    assert ht.text_of(deep("<script>var leak=1</script><p hidden>secret</p>hi")) == "hi"
    assert ht.text_of(deep("<section style='display:none'>a<div>b</div></section>c<p>d")) == "c\n\nd"
    assert ht.text_of(deep("<div style='visibility:hidden'>a<b style='visibility: visible'>seen</b>b</div>c")) == "seen\nc"
    assert ht.text_of("<div style='visibility:hidden'>" + deep("a<b style='visibility:visible'>x</b>") + "</div>y") == "x\ny"
    assert ht.text_of("<div hidden>" + deep("a") + "</div>b") == "b"
    assert ht.text_of(deep("<ul><li hidden>a<li>b</ul><template>t<div>u</div></template>")) == "b"
    assert ht.text_of(deep("one<div>two</div>three", 5000)) == "one\ntwo\nthree"
    assert ht.text_of(deep("<svg><defs/><text>seen</text><desc>no</desc></svg>")) == "seen"


def test_visibility_inputs_and_details():
    page = "<div style='visibility:hidden'>a<p style='visibility:visible'>b<i style='visibility:collapse'>c</i></p>d</div>e"
    assert ht.text_of(page) == "b\n\ne"
    assert ht.text_of("<table style='visibility:hidden'><tr><td>a<td style='visibility:visible'>b</table>") == "  b"
    assert ht.text_of("Name <input value=Ann> <input type=hidden value=x><input type=submit value=Go><input type=PASSWORD value=p>") == "Name Ann Go"
    assert ht.text_of("<details><summary>More</summary><p>inside</details>after") == "More\nafter"
    assert ht.text_of("<details open><summary>More</summary><p>inside</details>") == "More\n\ninside"


def test_cells_of_several_rows_and_columns():
    assert ht.text_of("<table><tr><td rowspan=2>A<td>b1<tr><td>b2<tr><td>C<td>b3</table>") == "A  b1\n   b2\nC  b3"
    page = "<table><tr><td>one<td rowspan=3>two<td>three<tr><td>x<td>y<tr><td colspan=1>z<td>w<tr><td colspan=2>wide<td>end</table>"
    assert ht.text_of(page) == "one  two  three\nx         y\nz         w\nwide      end"


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None), (2, ""), (3, "<p>a"), (3, "<p>a"), (None, "<li>x</ul>y"), (5, deep), (6, "a < b <3 <!-- c --> &nbsp;d"),
            (7, "<table><td>a<td colspan=2>b<tr>text</table>"), (8, "\0<p>z"), (9, "<ol start='x'><li>q")]
    pages = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "1 AS text", "2 AS __x", "3 AS __html")
    got = {(r.page_id, r.text) for r in ht.extract(pages).collect()}
    assert {(1, ""), (2, ""), (3, "a"), (5, "deep"), (8, "z"), (9, "1. q")} <= got
    assert any(k is None and "x" in t and "y" in t for k, t in got)
    assert ht.extract(pages.limit(0)).count() == 0


def _seen(page):
    """Words of a page by cutting out what isn't shown, then all tags."""
    page = re.sub(r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1\s*>|<!doctype[^>]*>", " ", page)
    page = re.sub(r"(?i)</?(b|i|a|em|strong|span|u|code)\b[^>]*>", "", page)
    return html.unescape(re.sub(r"<[^>]*>", " ", page)).split()


def test_op4_shows_every_visible_word(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    rows = {r.page_id: r.text for r in op4(spark, SF001).collect()}
    assert rows.keys() == pages.keys()
    same = 0
    for k, page in pages.items():
        shown = Counter(w for w in rows[k].split() if not re.fullmatch(r"-|\d+\.", w))
        want = Counter(w for w in _seen(page) if not re.fullmatch(r"-|\d+\.", w))
        same += shown == want
    assert same >= 0.97 * len(pages)


def test_pipeline_stages(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = [docs]
    for name, apply in cp.STAGES[:-1]:
        path = tempfile.mkdtemp(prefix="candlewick-test-") + "/" + name
        apply(spark, kept[-1], SF001).write.parquet(path)
        kept.append(spark.read.parquet(path))
        assert kept[-1].columns == docs.columns
        assert kept[-1].exceptAll(kept[-2]).isEmpty() and kept[-1].count() > 0.5 * kept[-2].count()
    groups = neardup.components(spark, kept[2])
    assert kept[3].count() == groups.filter("first").count()
    packed = cp.STAGES[-1][1](spark, kept[-1], SF001)
    assert packed.select("doc_id").distinct().count() == kept[-1].count()
    for docs in (odd_docs, no_docs):
        for _, apply in cp.STAGES:
            docs = apply(spark, docs, SF001)
        docs.count()
        assert "sequence_id" in docs.columns


def test_one_row_of_each_group_stays(spark, odd_docs):
    kept = neardup.keep_one(spark, odd_docs)
    groups = neardup.components(spark, odd_docs)
    assert kept.count() == groups.filter("first").count()
    assert kept.filter("doc_id = 7").count() == 1 and kept.columns == odd_docs.columns
