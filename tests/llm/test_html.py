import html
import re
import sys
import time
from html.parser import HTMLParser
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import table  # noqa: E402

from skylag.llm.html_text import page_text, rendered  # noqa: E402
from skylag.llm.queries import QUERIES  # noqa: E402

CASES = {
    "": "",
    "plain &amp; simple &lt;b&gt;": "plain & simple <b>",
    "<p>one<p>two": "one\n\ntwo",
    "<div>a<div>b</div>c</div>d": "a\nb\nc\nd",
    "<title>t</title><style>s</style><body>x<script>'</p>'</script>y": "xy",
    "<p>a\n  b <b> c</b>d<br>e</p>": "a b cd\ne",
    "<ul><li>one<li>two<ul><li>in</ul><li>three</ul>after": "- one\n- two\n  - in\n- three\n\nafter",
    "<ol start=3><li>c<li><p>d</p><p>e</p></ol>": "3. c\n4. d\n\n   e",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<pre>a\n  b\n\nc</pre>": "a\n  b\n\nc",
    "<p hidden>x</p><p style='color:red; display : none'>y<p style='visibility:hidden'>z</p>w": "w",
    "<p title='a > b' data-x=\"hidden\">shown</p>": "shown",
    "<!-- a > b --><!doctype html><?x y?>t<!-- open": "t",
    "a < b <1 <": "a < b <1 <",
    "x<template>y</template><noscript>z</noscript><textarea>t\nu</textarea>": "xt\nu",
    "<head><meta charset=x>body text": "body text",
    "<select><option>a<option>b</select>": "a\nb",
    "<p>x</p></p></div></table><td>y": "x\n\ny",
    "a<b": "a",
    "&nbsp;x&nbsp;y": "\xa0x\xa0y",
}


@pytest.mark.parametrize("source", CASES)
def test_layout(source):
    assert page_text(source) == CASES[source]


def test_tables_are_aligned():
    source = (
        "before<table><caption>Prices</caption><thead><tr><th>Item<th>Cost</thead>"
        "<tr><td>Long name</td><td>1</td><tr><td>b<td><p>2</p><p>3</p></table>after"
    )
    assert page_text(source) == (
        "before\n\nPrices\nItem       Cost\nLong name  1\nb          2\n\n           3\n\nafter"
    )


def test_spans_and_nested_tables():
    source = (
        "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td colspan=2>wide cell<td>f</table>"
        "<table><tr><td><table><tr><td>x<td>y</table><td>z</table>"
    )
    assert page_text(source).split("\n") == [
        "a  b  c", "   d  e", "wide cell  f", "", "x  y  z",
    ]


def test_wide_cells_do_not_widen_columns():
    text = page_text(f"<table><tr><td>{'w' * 500}<td>b<tr><td>a<td>c</table>")
    assert text == "w" * 500 + "  b\na  c"


def test_deep_and_long_pages_take_linear_time():
    begun = time.process_time()
    deep = page_text("<div>" * 20_000 + "x")
    rows = page_text("<table>" + "<tr><td>a<td>b" * 10_000)
    lists = page_text("<ul><li>a" * 3_000)
    assert deep == "x" and rows.count("\n") == 9_999 and lists.count("a") == 3_000
    assert page_text('<p "' * 5_000 + "x") is not None
    assert time.process_time() - begun < 60


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    "<p> </p> <div> </div> <table> <tr> <td> </td> </tr> </table> <ul> <li> </ul> <b> </b> <br> <pre>"
    " </pre> <head> <caption> <script> </script> <option> text more &amp; < <!-- -->".split(" ")
), max_size=25))
def test_any_mix_of_tags_is_rendered(parts):
    page_text("".join(parts))


class Words(HTMLParser):
    """Another way to the words that are not in raw or head elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title", "noscript", "template")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title", "noscript", "template")

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)


def test_query_keeps_all_visible_words(spark, sf_dir):
    found = {r.page_id: r.text for r in QUERIES["op3_html_text"](spark, sf_dir).collect()}
    rows = table(sf_dir, "pages")
    assert len(found) == len(rows)
    for page_id, _, source in rows:
        other = Words()
        other.feed(source)
        letters = re.sub(r"\s+", "", "".join(other.words))
        mine = re.sub(r"(?m)^ *(- |\d+\. )", "", found[page_id])
        assert sorted(re.sub(r"\s+", "", mine)) == sorted(letters) or "hidden" in source or (
            len(re.sub(r"\s+", "", mine)) >= 0.9 * len(letters)
        )


def test_nulls_clashing_columns_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "x", 1), ("<p>a", "x", 2)] * 2, "html string, TEXT string, n int")
    out = rendered(df)
    assert out.columns == ["n", "text"]
    assert sorted((r.n, r.text) for r in out.collect()) == [(1, None)] * 2 + [(2, "a")] * 2
    assert rendered(df.limit(0)).count() == 0
    assert page_text(html.escape("<p>") * 3) == "<p><p><p>"
