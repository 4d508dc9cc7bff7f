"""Bodies of pages: nested furniture and blocks, entities, embedded data."""

import time

from pyspark.sql import functions as F

from vigil.functions import html, markup


def lines(page, *exclude):
    nodes = markup.parse(page)
    return markup.blocks(nodes, 0, len(nodes), [t for t in map(markup.selector, exclude) if t]).split("\n")


def test_nested_furniture_goes_whole():
    page = "<div class='x related'><p>evil.com</p><div><p>more</p></div></div><aside><p>a</p><aside><p>b</p></aside><p>c</p></aside><div class='my-sidebar-2'><p>s</p></div><p>keep</p><div class='views'><p>seen</p></div>"
    assert lines(page) == ["keep", "seen"]
    assert lines("<form><p>f<div><p>g</div></form><p>k<script>if (a<b) '</p>'</script> end") == ["k end"]


def test_nested_blocks_and_left_out_ends():
    assert lines("<blockquote><p>one</p><p>two</p></blockquote>") == ["one two", "one", "two"]
    assert lines("<p>keep<p>me <b>now</b><br>too") == ["keep", "me now too"]
    assert lines("<table><tr><td>1<td>2<tr><td>3</table><ul><li>i<ul><li>j</ul><li>k</ul>") == ["1 2", "3", "i j", "j", "k"]
    assert lines("<h2>Head &amp; more</h2><pre> x\n y</pre><p></p><p>z</p><p>z</p>")[0] == "## Head & more"
    assert lines("no <i>blocks</i> at all") == ["no", "blocks", "at all"]


def test_selectors():
    page = "<main><div id='a' class='one two' data-k='v'><p>in</p></div><section><div class=one><p>under</p></div></section><p>out</p></main>"
    assert lines(page, "div.one") == ["out"] and lines(page, "section .one") == ["in", "out"] and lines(page, "#a, nothing") == ["under", "out"]
    assert lines(page, "[data-k='v']") == ["under", "out"] and lines(page, "div[[[not") == ["in", "under", "out"] and markup.selector("a > b") is None


def test_exclusions_of_a_source(spark):
    page = """<html><body><article><p>Attackers exploited the flaw to run code remotely on the appliance.</p>
      <div class="zox-side-widget"><h3>People on the Move</h3><div class="industry-moves"><p>Someone has joined as Chief Marketing Officer.</p></div></div>
      <div class="page-date page-date--btm">4 Sep 2026 2297 Views</div><p>The vendor shipped a patch on Tuesday for all supported releases.</p></article></body></html>"""
    rows = spark.createDataFrame([(page, "t", ["article"], ["div.zox-side-widget", "div[[[not-a-selector"])], "html string, title string, article_selectors array<string>, exclude_selectors array<string>")
    got = html.choose_body(rows, 50).first()
    assert got.method == "site-selector:article" and got.body.split("\n") == ["Attackers exploited the flaw to run code remotely on the appliance.", "The vendor shipped a patch on Tuesday for all supported releases."]


def test_entities(spark):
    text = "it&rsquo;s &#8217; &hellip; &#x27; &eacute; a&#46;com &nbsp; x &notanentity; AT&T"
    assert spark.createDataFrame([(text,), (None,)], "t string").select(markup.clean_text(F.col("t")).alias("c")).collect()[0].c == "it’s ’ … ' é a.com x ¬anentity; AT&T"


def test_embedded_data():
    script = lambda s: f'<script type="application/ld+json">{s}</script>'
    deep = script('{"@graph": [{"@graph": [{"articleBody": "deep &amp; down"}]}, {"articleBody": 5}, {"articleBody": "second"}, "x"]}')
    many = script("[" + ",".join(f'{{"articleBody": "b{k}"}}' for k in range(100)) + "]")
    found = lambda page: list(markup.embedded_bodies(markup.parse(page)))
    assert found(deep) == ["second", "deep & down"] and len(found(many)) == 64 and found(script("{bad") + script('"text"') + script('{"articleBody": "y"}')) == ["y"]


def test_work_grows_with_the_page():
    def took(n):
        began = time.time()
        for page in ("<a '" * n, "<div>" * n + "<p>x" * n, "<ul><li>" * n, "<" * n, "<!--" * n, "</p>" * n):
            markup.parse(page)
        return time.time() - began

    few = took(3_000)
    assert took(30_000) < 25 * few + 2


def test_references_without_semicolon_stay(spark):
    """As the SQL of page_bodies reads them: a title that was cut inside a reference keeps what is left of it."""
    words = "word " * 120
    page = f"<html><title>t</title><article><h1>One &amp; two&amp</h1><p>{words}&lt;b&gt; &amp;&amp;&lt</p></article></html>"
    body = html.choose_body(spark.createDataFrame([(page, "t")], "html string, title string")).first().body
    assert body.split("\n")[0] == "## One & two&amp" and body.endswith("&&&lt")
