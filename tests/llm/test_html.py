import random
from html import unescape
from html.parser import HTMLParser

from docloom.llm import html

PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies, accept all of them today</div>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><article><header><h2>Head &amp; line</h2></header><p>First <em>words</em>
 of it &lt;b&gt;.<p>Second goes on.<aside>Related story is long enough to matter for us all</aside><p>Third&nbsp;one.<br>After a break.
<ul><li>item one<li>item two</ul><form>Subscribe <input name=q> now please</form><p>Yes.</article>
<div class="comments"><p>I disagree strongly and say so in many words here.</p></div><div class=sidebar>Popular things to read now</div><footer>&copy; 2020</footer><script>var a="<p>no</p>";</script></body></html>"""
TEXT = "Head & line\nFirst words of it <b>.\nSecond goes on.\nThird one.\nAfter a break.\nitem one\nitem two\nYes."


def test_article_with_and_without_learnt_weights(spark):
    rows = [(i, f"u{i}", PAGE) for i in range(3)] + [(3, None, None), (4, "", ""), (5, "x", PAGE.replace("<article>", "<div>").replace("</article>", "</div>"))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumnRenamed("url", "kind")
    weight = html.learn(pages)
    assert weight["w:p"] > 0 > weight["nav"] and weight["p"] < 0
    got = {r["page_id"]: r["text"] for r in html.add_text(pages, weight).collect()}
    assert got[0] == got[1] == got[2] == TEXT
    assert got[3] == got[4] == ""
    assert got[5] == TEXT.split("\n", 1)[1]  # outside an article a header is the page's
    assert html.extract(PAGE, {}) == TEXT


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    weight = html.learn(pages)
    assert weight == {} and html.add_text(pages, weight).count() == 0


def test_broken_markup():
    cases = {
        "<": "<", "a<b": "a<b", "<!-- x": "", "<p>only words here": "only words here", "<script>x": "", "plain text": "plain text", "</p></p><td>x y": "x y",
        "<p title='a>b'>quoted</p>": "quoted", "<b>" * 30000 + "deep": "deep", "a &amp b &#233; &bogus; c": "a & b é &bogus; c", "<p>x</p><!DOCTYPE y><p>z</p>": "x\nz",
    }
    for page, text in cases.items():
        assert html.extract(page, {}) == text, page[:40]


def test_long_page_is_whole():
    page = "<html><body><nav><a>m</a></nav><article>" + "".join(f"<p>word{i} other{i}</p>" for i in range(20000)) + "</article></body></html>"
    assert html.extract(page, {}).count("\n") == 19999


def test_best_region_is_the_maximum():
    scores = [1.0, -2.0, 3.0, -1.0, 2.0, -5.0, 4.0, 0.5]
    best = max(sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1))
    a, b = html.best_region(scores)
    assert sum(scores[a:b]) == best
    assert html.best_region([-1.0, -2.0]) == (0, 0) and html.best_region([]) == (0, 0)


def test_hints_on_wrappers_and_headings_keep_the_article():
    nav, body = "<nav><a>one</a> <a>two</a></nav>", "".join(f"<p>word{i} goes on and on here.</p>" for i in range(12))
    text = "\n".join(f"word{i} goes on and on here." for i in range(12))
    for open_, close in (("<div class='wrap has-sidebar'>", "</div>"), ("<div id=page class=no-sidebar>", "</div>"), ("<div class='post category-social'>", "</div>"), ("<div class=has-sidebar><main>", "</main></div>"), ("<form><main>", "</main></form>"), ("<main><div class=social>", "</div></main>")):
        assert html.extract(f"<body>{nav}{open_}{body}{close}<footer>end of it</footer></body>", {}) == text, open_
    page = f"<body>{nav}<article><h2 id=related-work>Related work</h2>{body}<p class=search-results>Found ten.</p><p class=ad>Buy this.</p><div class=share>Tell all.</div></article></body>"
    assert html.extract(page, {}) == f"Related work\n{text}\nFound ten."


def test_unfinished_tags_are_read_once():
    import time

    for page in ("<a " * 200_000, "<a b='" * 100_001 + ">", "<p>x</p>" + "<" * 300_000, '<a ">' * 60_001, "<p>text</p><!-- " * 50_000):
        start = time.time()
        html.extract(page, {})
        assert time.time() - start < 20
    assert html.extract("<p>one two three</p><b", {}).split("\n")[0] == "one two three"


def test_text_column_of_any_name(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>one two three</p></article>", "mine")], "page_id bigint, url string, html string, text string")
    row = html.add_text(pages, {}, name="article").first()
    assert row["text"] == "mine" and row["article"] == "one two three"


def random_page(r, depth=0):
    """Balanced markup with attributes, comments, references and skipped elements."""
    out = []
    for _ in range(r.randrange(1, 5)):
        pick = r.random()
        if pick < 0.45 or depth > 4:
            out.append(r.choice(["plain words here", "a &lt; b &amp; c", " spaced\n out ", "caf\u00e9 &#233;t\u00e9", "one"]))
        elif pick < 0.55:
            out.append(r.choice(["<!-- <p>not this</p> -->", "<br>", "<img alt='x > y'>", "<hr/>", "<!DOCTYPE html>"]))
        elif pick < 0.65:
            name = r.choice(["script", "style", "textarea", "title"])
            out.append(f"<{name}>var hidden = 'words';</{name}>")
        else:
            name = r.choice(["div", "section", "span", "em", "b", "ul", "table", "blockquote", "article", "nav"])
            out.append(f"<{name} data-x=\"{r.choice(['1', 'a>b', ''])}\">{random_page(r, depth + 1)}</{name}>")
    return "".join(out)


class Plain(HTMLParser):
    """Words outside skipped elements, by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.skipped = [], 0

    def handle_starttag(self, tag, attrs):
        self.skipped += tag in html.SKIPPED and tag not in html.VOID

    def handle_endtag(self, tag):
        self.skipped -= tag in html.SKIPPED and tag not in html.VOID

    def handle_data(self, data):
        if not self.skipped:
            self.words += data.split()


def test_events_hold_the_words_of_a_plain_parser():
    r = random.Random(3)
    for _ in range(300):
        page = random_page(r)
        plain = Plain()
        plain.feed(page)
        plain.close()
        said = [w for _, _, text, _, _, _ in html.events(page) if text is not None for w in unescape(text).split()]
        assert "".join(said) == "".join(plain.words), page


def test_best_region_equals_all_runs():
    r = random.Random(5)
    for _ in range(300):
        scores = [r.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(r.randrange(14))]
        a, b = html.best_region(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
        assert sum(scores[a:b]) == best
