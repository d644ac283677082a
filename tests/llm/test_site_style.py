"""Main text against an independent reader of the test pages, and made-up sites."""

import math
from html.parser import HTMLParser

import pandas as pd
import pytest

from stratalake.llm.registry import op2_html_extraction
from stratalake.llm.site_style import EAGER, extract, main_text, style_tree

SF = "/root/testdata/sf0.01"


class Article(HTMLParser):
    """Texts of h1 and p inside article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.now = False, [], ""

    def end_block(self):
        if self.now.split():
            self.blocks.append(" ".join(self.now.split()))
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "h1", "p", "footer"):
            self.end_block()
        self.inside = tag == "article" or self.inside and tag != "footer"
        if tag == "br":
            self.now += " "

    def handle_endtag(self, tag):
        if tag in ("article", "h1", "p"):
            self.end_block()
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.now += data


def test_query_over_all_pages(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")
    got = op2_html_extraction(spark, SF).toPandas()
    assert sorted(got.page_id) == sorted(pages.index)
    for row in got.itertuples():
        reader = Article()
        reader.feed(pages.html[row.page_id])
        reader.close()
        reader.end_block()
        assert row.text == "\n".join(reader.blocks), row.page_id
        assert row.n_chars == len(row.text) > 0 and row.url == pages.url[row.page_id]


CASES = {
    "<p>a</p>": "a",
    "<nav>m</nav><p>a &amp;amp; b&eacute;&#233;&#xe9;&#9999999;</p>": "a &amp; béé�é".replace("�é", "é�"),
    "<article><header>h</header><h1> T\n t </h1>x<p>a<b>b</b> c<br>d<p>e</article><p>out</p>": "T t\nx\nab c d\ne",
    "<div class='sidebar'>s</div><div id=main-content>k<div class='userComments'>c</div></div>": "k",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "a\nb\nc\nd",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "<script>var a='<p>no</p>';</script><style>x</style><!-- <p>no</p> --><p>yes": "yes",
    "<p title='a > b'>q</p><form>f<p>g</p></form><p>h": "q\nh",
    "a < b and c > d": "a < b and c > d",
    "<p>x<script>never closed": "x",
    "<p title='unclosed>y</p><p>z</p>": "y\nz",
    "<div role=banner>b</div><div>k</div></div></p></span>tail": "k\ntail",
    "<!DOCTYPE html><html><head><title>t</title></head><body><footer>f": "",
    "<p>a</p>" * 3: "a\na\na",
    "": "",
    "<main><div class=ad-box>x</div><p>k&nbsp; l</p></main><div>o</div>": "k l",
}


@pytest.mark.parametrize("page", CASES)
def test_reading(page):
    assert extract(page, set()) == CASES[page]


def _site(n, host="h.example"):
    def page(i):
        words = " ".join(f"w{i}x{k}" for k in range(20))
        return (
            f"<html><body><div class='top'><p>Welcome to our site</p></div><div class='body'><p>{words}</p>"
            f"<p>second {i}</p></div><div class='legal'>All rights kept, see <a href='/{i}'>terms</a></div></body></html>"
        )

    return [(i, f"http://{host}/{i}", page(i)) for i in range(n)]


def _texts(spark, rows, **how):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.selectExpr("*", "1 AS text", "2 AS host", "3 AS node")
    return {(r.page_id, r.url): r.text for r in main_text(frame, **how).collect()}


@pytest.mark.parametrize("broadcast_nodes", [0, 1_000_000])
def test_branches_that_are_the_same_on_all_pages_go(spark, broadcast_nodes):
    rows = _site(30) + [(100 + i, u.replace("h.e", "few.e"), h) for i, u, h in _site(3)]
    got = _texts(spark, rows, broadcast_nodes=broadcast_nodes)
    for i in range(30):
        words = " ".join(f"w{i}x{k}" for k in range(20))
        assert got[i, f"http://h.example/{i}"] == f"{words}\nsecond {i}"
    assert got[100, "http://few.example/0"].startswith("Welcome to our site\nw0x0")


def test_a_host_of_copies_keeps_its_text(spark):
    page = "<article><h1>T</h1><p>same text everywhere</p></article>"
    got = _texts(spark, [(i, f"http://c.example/{i}", page) for i in range(20)])
    assert set(got.values()) == {"T\nsame text everywhere"}


def test_importance_is_the_entropy(spark):
    rows = [(i, "http://e.example/", f"<div class=a>{'same' if i < 4 else i}</div>") for i in range(8)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    node = style_tree(frame).where("content < 1").collect()
    assert len(node) == 1 and node[0].presentation == 0
    # Five texts, one of them on four of the eight pages.
    assert node[0].pages == 8
    assert math.isclose(node[0].content, 1 - (math.log(4) / 5) / math.log(8))


def test_odd_rows(spark):
    rows = [
        (1, None, None), (1, None, None), (None, "x", ""), (2, "http://h/", "<p>" + "long word " * 200_000),
        (3, "HTTP://User@H:80/p", "\x00<p>\x00a"), (4, "", "<" * 5000), (5, "", "<p class='" * 300),
    ]
    got = _texts(spark, rows)
    assert got[1, None] == "" and got[None, "x"] == "" and len(got[2, "http://h/"]) == 10 * 200_000 - 1
    assert got[4, ""] == "<" * 5000
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text(frame).collect() == []


WRAPPED = {
    "<div class='layout no-sidebar'><article><p>long text</p></article></div><div class='sidebar'>s</div>": "long text",
    "<div class='content has-sidebar'><p>long text of it</p><div class='sidebar'>s</div></div>": "long text of it",
    "<div class='post comments-open'><div class='entry-header'><h1>T</h1></div><p>long text</p></div>": "T\nlong text",
    "<article class='post comments-open'><p>text of it</p></article><div class=comments><article "
    "class='comment-body'>reply</article></div>": "text of it",
    "<form><div class=menu>m</div><p>the whole page lies in a form</p></form>": "the whole page lies in a form",
    "<aside><main><p>k</p></main></aside>": "k",
    "<p>one <span class='share'>x</span> line, foo<button>b</button>bar</p>": "one line, foobar",
}


@pytest.mark.parametrize("page", WRAPPED)
def test_wrappers_with_a_noise_word_keep_the_article(page):
    assert extract(page, set()) == WRAPPED[page]


@pytest.mark.parametrize("broadcast_nodes", [0, 1_000_000])
def test_names_lower_importance_and_the_tree_decides(spark, broadcast_nodes):
    def page(i):
        return (
            f"<body><div class='lead banner-text'>lead of {i}</div><div class='info-banner'>same for all</div>"
            f"<div class='sidebar'><p>side {i % 2}</p></div><p>{' '.join(f'w{i}x{k}' for k in range(20))}</p></body>"
        )

    rows = [(i, f"http://n.example/{i}", page(i)) for i in range(12)]
    got = _texts(spark, rows, broadcast_nodes=broadcast_nodes)
    for i in range(12):
        words = " ".join(f"w{i}x{k}" for k in range(20))
        assert got[i, f"http://n.example/{i}"] == f"lead of {i}\n{words}"


@pytest.mark.parametrize("broadcast_nodes", [0, 1_000_000])
def test_few_pages_and_stubs_lose_the_same_blocks(spark, broadcast_nodes):
    rows = _site(2) + [(100 + i, u.replace("h.e", "seven.e"), h) for i, u, h in _site(7)]
    menu = "<div class='list'>" + "<p>same long entry</p>" * 40 + "</div>"
    stub = [(200 + i, f"http://stub.example/{i}", f"<body>{menu}<div class=t>short {i}</div></body>") for i in range(9)]
    copied = [(300 + i, f"http://copy.example/{i}", f"<body><div>one</div><div>text</div><a href='{i}'></a></body>") for i in range(9)]
    got = _texts(spark, rows + stub + copied, broadcast_nodes=broadcast_nodes, caution=EAGER)
    for (i, _), text in got.items():
        if i < 200:
            words = " ".join(f"w{i % 100}x{k}" for k in range(20))
            assert text == f"{words}\nsecond {i % 100}"
        else:
            assert text == (f"short {i - 200}" if i < 300 else "one\ntext")


def _words(i, n=20):
    return " ".join(f"w{i}x{k}" for k in range(n))


def _article(host, pages, **how):
    rows = [(i, f"http://{host}/{i}", html) for i, html in enumerate(pages)]
    got = _texts(spark=how.pop("spark"), rows=rows, caution=EAGER, **how)
    return [got[i, f"http://{host}/{i}"] for i in range(len(pages))]


@pytest.mark.parametrize("broadcast_nodes", [0, 1_000_000])
def test_versions_of_one_article_keep_it(spark, broadcast_nodes):
    def page(i, views):
        return (
            f"<body><div class=top>Most read today: {['cats', 'dogs', 'fish'][i % 3]}</div><article><h1>T {views}</h1>"
            f"<p>{_words(1)}</p><p>the end</p></article></body>"
        )

    for n in (2, 3, 9):
        got = _article(f"v{n}.example", [page(i, i) for i in range(n)], spark=spark, broadcast_nodes=broadcast_nodes)
        assert got == [f"T {i}\n{_words(1)}\nthe end" for i in range(n)]


def test_near_copies_of_one_article_keep_it(spark):
    pages = [
        f"<body><div>same</div><main><h1>T</h1><p class=a>{_words(1)}</p><p class=b>{_words(2)}</p>"
        f"<div class=views>seen by {'x' * (i + 1)}</div></main></body>"
        for i in range(8)
    ]
    got = _article("near.example", pages, spark=spark)
    assert got == [f"T\n{_words(1)}\n{_words(2)}\nseen by {'x' * (i + 1)}" for i in range(8)]


def test_a_sentence_that_two_articles_share_stays(spark):
    pages = [
        f"<main><h1>Soup {w}</h1><p class=yield>Serves four people.</p><p>{_words(w)}</p></main>" for w in "ab"
    ]
    got = _article("r.example", pages, spark=spark)
    assert got == [f"Soup {w}\nServes four people.\n{_words(w)}" for w in "ab"]


def test_a_line_in_all_of_many_different_articles_goes(spark):
    pages = [
        f"<article><p>{_words(i)}</p><div class=follow><p>Follow us for more</p></div></article>" for i in range(12)
    ]
    assert _article("f.example", pages, spark=spark) == [_words(i) for i in range(12)]


def test_a_header_with_a_headline_belongs_to_its_article():
    page = (
        "<header><h1>Site</h1></header><article><header><h2>T</h2><p>by me</p><nav>n</nav></header><p>text</p>"
        "<section><header>no headline</header><p>more</p></section><footer>f</footer></article>"
    )
    assert extract(page, set()) == "T\nby me\ntext\nmore"


def test_unclosed_tags_cost_in_proportion(spark):
    deep = {n: "<div class='c'><p>" * n + "x" for n in (12_500, 50_000)}
    assert [extract(page, set()) for page in deep.values()] == ["x", "x"]
    rows = [(1, "http://deep.example/1", deep[50_000]), (2, "http://deep.example/2", "<nav>" * 100_000 + "<main>y")]
    got = _texts(spark, rows, caution=EAGER)
    assert got == {(1, rows[0][1]): "x", (2, rows[1][1]): "y"}
