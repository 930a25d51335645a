import html
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import Row

from covey.llm import mainpage

DATA = "/root/testdata/sf0.01"


class Article(HTMLParser):
    """Blocks of the one article of a page of the test tables, by the library's parser."""

    def __init__(self, page):
        super().__init__()
        self.on, self.blocks = False, [""]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        self.on |= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.on &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.on:
            self.blocks[-1] += data


def test_pages_of_the_tables(spark):
    got = {r["page_id"]: r for r in mainpage.op9_main_text(spark, DATA).collect()}
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        want = "\n\n".join(b for b in (" ".join(x.split()) for x in Article(page["html"]).blocks) if b)
        assert got[page["page_id"]]["text"] == want
        assert got[page["page_id"]]["n_chars"] == len(want)


BODY = " ".join(f"word{i}" for i in range(60))


def test_boilerplate_goes():
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body class="has-sidebar"><header><h1>Site name</h1></header>
    <nav><ul><li><a href=/>Home page of it all</a></li></ul></nav><div class="cookie-notice">We use cookies for many good reasons here</div>
    <article><header><h1>A title</h1></header><p>One &amp; two&nbsp;three <b>four</b>five<br>six</p><div role="complementary"><p>Buy this now</p></div>
    <p>{BODY}</p><form class=x><label>Name</label><input></form><ul><li>first<li>second</ul><script>var x = "<p>no</p>";</script></article>
    <section id="comments"><p>I think that this is a very long comment by a reader who says much. {BODY} {BODY}</p></section>
    <aside>Related things</aside><footer>&copy; 2024</footer></body></html>"""
    for weights in ({}, {"tag free p": -0.2}):
        assert mainpage.extract(page, weights) == f"A title\n\nOne & two three fourfive six\n\n{BODY}\n\nfirst\n\nsecond"


def test_without_a_mark():
    page = f"<body><div id=menu><a href=x>one two three four</a></div><div><h1>Title</h1><p>{BODY}</p><p>{BODY} end</p></div><div class=footer>all rights</div>"
    assert mainpage.extract(page, {}) == f"Title\n\n{BODY}\n\n{BODY} end"


def test_scan_is_the_best_range():
    """The linear scan against all ranges."""
    pages = ["<p>a b<p>c<br><i>x</i><div><div><div></div>d e f g", "<a>x y z</a><p>one</p><hr><hr><hr><p>two three four</p>", "x<br><br><br><br>y"]
    for page in pages:
        tokens = mainpage.read(page)
        score = [mainpage.weight({}, mainpage.tag_class(t[1], t[3], False)) if t[0] == "tag" else len(t[1].split()) * mainpage.weight({}, mainpage.word_class(*t[2:6], False)) for t in tokens]
        best = max(((sum(score[i:j]), -i, -j) for i in range(len(tokens)) for j in range(i + 1, len(tokens) + 1)))
        words = [w for t in tokens[-best[1] : -best[2]] if t[0] == "text" for w in t[1].split()]
        assert mainpage.extract(page, {}).split() == words


def test_odd_rows(spark):
    rows = [Row(page_id=1, url=None, html=None, text="x"), Row(page_id=2, url="u", html="", text=None), Row(page_id=2, url="u", html="<p>x" * 30000, text=None), Row(page_id=None, url="u", html="plain words < only <b", text=None), Row(page_id=5, url="u", html="<!-- open <p>x y z", text=None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in mainpage.main_text(df, mainpage.learn(df)).collect() if r["page_id"] != 2}
    assert got == {1: "", None: "plain words < only", 5: ""}
    assert mainpage.main_text(df, {}).count() == 5 and mainpage.main_text(df.limit(0), {}).count() == 0
    assert re.fullmatch(r"x(\n\nx)*", mainpage.extract("<p>x" * 30000, {}))
    assert mainpage.extract("<p>one two</p><a title=\"x>three</a><p>four</p>" + "<b>" * 20000 + "</i>" * 20000 + "five", {}).split()[:2] == ["one", "two"]
    assert html.unescape("&lt;") in mainpage.extract("<p>a &lt; b", {})


def test_tags_that_leave_nothing_out():
    page = "<article><p>one two three</p>{}<p>four five six</p></article>"
    for tag in ("<svg-icon></svg-icon>", "<button-link>", "<svg class=i/>", "<svg/>", "<iframe src=x />", "<button>", "<video src='a>b'>"):
        assert mainpage.extract(page.format(tag), {}) == "one two three\n\nfour five six", tag
    for element in ("<svg><path/>no</svg >", "<BUTTON type=x>no</Button>", "<script>a < b; '<p>no</p>'</script>", "<iframe>no</iframe>", "<script src=/a/>no</script>"):
        assert mainpage.extract(page.format(element), {}) == "one two three\n\nfour five six", element
    assert mainpage.extract(page.format("<script>"), {}) == "one two three"
    assert [t[1] for t in mainpage.read(page.format("<button>" * 20_000)) if t[0] == "text"] == ["one two three", "four five six"]


KEPT = [
    ('<h2 id="search-and-navigation">Search and navigation</h2>', "Search and navigation"),
    ('<p class="legal">The law says so</p>', "The law says so"),
    ('<div class="post-content share-price-report"><p>Prices rose again</p></div>', "Prices rose again"),
    ('<table id="related-work"><tr><td>one study</td></tr></table>', "one study"),
    ('<blockquote class="promoted-quote">as they said</blockquote>', "as they said"),
    ('<h2 id="share-of-voice">Share of voice</h2>', "Share of voice"),
    ('<p>some <span class="search">found words</span> here</p>', "some found words here"),
    ("<h3><button>What is it?</button></h3>", "What is it?"),
    ('<ul class="comment-guide"><li>point one</li></ul>', "point one"),
]


@pytest.mark.parametrize("mark", ["article", "main", "div"])
def test_names_cost_no_content(spark, mark):
    """Names that only sound like boilerplate: nothing of the article goes, whether weights are learned or not."""
    learned = mainpage.learn(spark.read.parquet(f"{DATA}/pages.parquet"))
    for html_, text in KEPT:
        page = f"<body><nav><a href=/>home page</a></nav><{mark}><h1>A title of it</h1><p>{BODY}</p>{html_}<p>{BODY}</p></{mark}><footer>the end</footer></body>"
        for weights in ({}, learned):
            assert mainpage.extract(page, weights) == f"A title of it\n\n{BODY}\n\n{text}\n\n{BODY}", html_


def test_pages_without_marks_or_telling_names(spark):
    """Weights that are learned from marked pages find the same text on pages without a mark, names gone or not."""
    pages = [r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    weights = mainpage.learn(spark.read.parquet(f"{DATA}/pages.parquet"))
    assert weights["name ad"] <= -3 and "cut ad" in weights
    for page in pages:
        want = mainpage.extract(page, weights)
        bare = page.replace("<article", "<div").replace("</article", "</div")
        assert mainpage.extract(bare, weights) == want
        assert mainpage.extract(bare.replace(' class="ad"', ""), weights) == want
        assert mainpage.extract(bare.replace(' class="ad"', ' class="k7"'), weights) == want
        inner = page.replace("</p>", '</p><div class="ad">Buy more of it now</div>', 1)  # an advert in the article
        assert mainpage.extract(inner, weights) == want


def test_names_are_learned(spark):
    """Names that no list has are boilerplate if labelled pages say so, and only then; any number of classes and names is fine."""
    page = "<body><div class='zq zz'>{} words beside it all</div><article><h1>Title</h1><div class='qz'><p>{} " + BODY + "</p></div></article><x-{}>odd</x-{}></body>"
    rows = [(k, page.format(k, k, k, k)) for k in range(3000)]
    weights = mainpage.learn(spark.createDataFrame(rows, "page_id long, html string"))
    assert "cut zq" in weights and "cut qz" not in weights and weights["name zq"] < -3 < 0 < weights["name qz"]
    assert len(weights) < 100  # 3000 elements that HTML doesn't have are one
    assert mainpage.extract(f"<article><p>{BODY}</p><div class='zq'><p>Buy</p></div><p class=zq>this stays</p><p>{BODY}</p></article>", weights) == f"{BODY}\n\nthis stays\n\n{BODY}"
    assert mainpage.extract(f"<div class='qz'><p>{BODY}</p></div><div class=zq><p>{BODY}</p></div>", weights) == BODY


def test_main_around_an_article():
    page = f"<main><article><p>{BODY}</p></article><section id=discussion><p>I say {BODY}</p></section></main>"
    assert mainpage.extract(page, {}) == BODY
    assert mainpage.extract(f"<main><p>{BODY}</p></main><div><p>x y</p></div>", {}) == BODY
