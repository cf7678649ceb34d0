from html.parser import HTMLParser

import pytest

from plumbline.llm.html_consensus import extract, host_paths, main_text, parse

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, path string"


def text(source):
    return extract(parse(source), None)


ARTICLE = "<article><h1>Head</h1><p>One  two\nthree.</p><p>Four &amp; five&#33;</p></article>"


@pytest.mark.parametrize("source, expected", [
    (f"<html><body><nav><ul><li><a href='/a'>menu</a></li></ul></nav>{ARTICLE}<footer>&copy; x</footer></body></html>", "Head\n\nOne two three.\n\nFour & five!"),
    ("<body><div class='ad'>buy buy buy buy</div><div class='content'><p>Text a<p>Text <b>b</b><br>c</div><!-- note --></body>", "Text a\n\nText b c"),
    ("<body><div class='sidebar-2'>side side side</div><main><p>Text</p><form>name<input></form><div id='comments'>reader says</div></main>", "Text"),
    ("<p>Only &lt;tags&gt; &eacute;&nbsp;x", "Only <tags> é x"),
    ("<body><article><p>cut off <a href='/x", "cut off"),
    ("<body><article><p>cut <script>var t='</p>';</script>here<style>p{}</style></article>", "cut here"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc\n\nd"),
    ("<body hidden-x class='has-menu'><p>kept</p></body>", "kept"),
    ("<div>a < b and 3<4</div>", "a < b and 3<4"),
    ("<head><title>t</title></head><body></body>", ""),
    ("", ""),
    ("<" * 500 + "div" + " x" * 500, None),
])
def test_pages(source, expected):
    found = text(source)
    assert expected is None or found == expected


BODY = "<h1>Head</h1><p>One two three four.</p><p>Five six seven.</p>"
WHOLE = "Head\n\nOne two three four.\n\nFive six seven."


@pytest.mark.parametrize("name", ["layout has-sidebar", "content no-sidebar", "long-form", "article-content with-comments", "container menu-open", "page_with_ads"])
def test_a_wrapper_is_not_muted_for_its_name(name):
    assert text(f"<body><nav>a b</nav><div class='{name}'>{BODY}<div class='sidebar'>side</div></div><div id='comments'>late</div></body>") == WHOLE
    assert text(f"<body><div id='{name}'><div class='share'>s</div><article>{BODY}</article></div></body>") == WHOLE


def test_noise_longer_than_the_article_is_muted():
    assert text(f"<body><div class='content'>{BODY}<div id='comments'><article class='comment'><p>{'late ' * 90}</p></article></div></div></body>") == WHOLE
    assert text(f"<body><div class='sidebar'>{'side ' * 90}</div><article>{BODY}<div class='related'><article>x</article></div></article></body>") == WHOLE
    assert text(f"<body><div class='container menu-open'>{BODY}</div><div id='comments'><p>{'late ' * 90}</p></div></body>") == WHOLE


@pytest.mark.parametrize("source", [
    f"<body><nav><svg class='i'/></nav><article><svg viewBox='0 0 1 1' />{BODY}</article></body>",
    f"<body><form method='post' action='/x.aspx'><nav>a b</nav><div class='content'>{BODY}</div><footer>f</footer></form></body>",
    f"<body><form id='aspnetForm'><div>{BODY}</div><div class='footer'>f</div></form></body>",
    f"<body><form><article>{BODY}<form class='subscribe'>mail <p>{'terms ' * 90}</p></form></article></form></body>",
    "<body><header>site</header><article><header><h1>Head</h1></header><p>One two three four.</p><p>Five six seven.</p><header><h2>x</h2></header></article></body>",
    "<body><header class='masthead'><h1>site</h1></header><article class='post'><div class='entry-header'><h1>Head</h1></div><p>One two three four.</p><p>Five six seven.</p></article></body>",
    f"<body><div title='a hidden gem' data-id='nav' data-x='display:none' aria-hidden=false>{BODY}</div><div HIDDEN>x</div><p style='color:red;display : none'>y</p><p aria-hidden=true>z</p></body>",
    f"<body><article>{BODY}<math><mi>x</mi></math></article></body>",
])
def test_icons_wrapping_forms_heads_of_articles_and_attributes(source):
    assert text(source) == WHOLE


class Plain(HTMLParser):
    """The blocks of an article, read by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.words = False, [], []

    def cut(self):
        block = " ".join("".join(self.words).split())
        self.words = []
        if block and self.inside:
            self.blocks.append(block)

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "p", "h1", "br"):
            self.cut() if tag != "br" else self.words.append(" ")
        self.inside = self.inside or tag == "article"

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1"):
            self.cut()
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        self.words.append(data if self.inside else "")


def test_given_pages_by_another_parser(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    rows = pages.select("page_id", "html").collect()
    assert len(got) == len(rows) > 0
    for r in rows:
        other = Plain()
        other.feed(r["html"] or "")
        other.close()
        assert got[r["page_id"]] == "\n\n".join(other.blocks)


def test_deep_and_long_pages():
    assert text("<div>" * 5000 + "<div class='menu'>" * 5000 + "x") == "x"

    assert text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert text("<article>" + "<p>word</p>" * 20000 + "</article>").count("word") == 20000


def test_the_host_decides(spark):
    shop = "<body><div class='c{}'><p>{}</p></div><div class='more{}'><p>{}</p></div></body>"
    rows = [(i, "http://A.x/p?q", shop.format(i, "main text " * 9, i, "other"), "z") for i in range(4)]
    # On this page the other block is longer, but the host's path wins.
    rows += [(9, "http://a.x/z", shop.format(7, "main text", 8, "other " * 40), None), (10, None, None, None), (11, "x", "", None),
             (12, "http://b.x", "<p>alone", None), (12, "http://b.x", "<p>alone", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r["host"]: r["path"] for r in host_paths(df).collect()} == {"a.x": ">body>div.c#"}
    got = sorted((r["page_id"], r["text"]) for r in main_text(df).collect())
    assert got == [(i, ("main text " * 9).strip()) for i in range(4)] + [(9, "main text"), (10, ""), (11, ""), (12, "alone"), (12, "alone")]
    assert main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_heading_lead_and_sections_around_an_inner_container_stay(spark):
    inner = "<div class='content'>" + "<p>word word word</p>" * 40 + "</div>"
    outer = "<body><div class='article'><h1>H</h1><p>lead</p>{}</div></body>".format(inner)
    assert text(outer).startswith("H\n\nlead\n\nword")
    assert text(f"<body><div class='article'>{inner}<div class='more'><h2>S</h2><p>last</p></div></div></body>").endswith("S\n\nlast")
    assert text(f"<body><h1>H</h1>{inner}</body>").startswith("H\n\nword")
    # Most pages of the host have no lead; the one that has one keeps it.
    rows = [(i, "http://h.x/", f"<body><div class='article'>{inner}</div></body>", None) for i in range(5)] + [(9, "http://h.x/", outer, None)]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[9].startswith("H\n\nlead\n\nword") and got[0].startswith("word")


def test_pages_of_another_template_give_their_own_article(spark):
    page = "<body><div class='content'><p>{}</p></div></body>"
    other = "<body><div class='content'><p>teaser</p></div><div class='story'><p>{}</p></div></body>".format("long story " * 30)
    for first, last in (("http://h.x/a", "http://h.x/b"), ("/a", None)):
        rows = [(i, first, page.format("main text " * 9), None) for i in range(5)] + [(9, last, other, None)]
        got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {i: ("main text " * 9).strip() for i in range(5)} | {9: ("long story " * 30).strip()}
