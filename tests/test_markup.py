import pytest
from pyspark.sql import functions as F

from newsflow.functions import elements, markup
from newsflow.functions.elements import Page
from newsflow.functions.markup import Rule
from newsflow.operators import articles as art
from newsflow.operators import links

PAGE = "page_id BIGINT, url STRING, html STRING"


def one(spark, html, use):
    """What ``use`` makes of the element table of a page."""
    return art.visible_pages(spark.createDataFrame([(1, "u", html)], PAGE)).select(use(Page())).first()[0]


RULES = [
    ('a[href*="tac-gia"]::text', True, '<a href="/tac-gia/x">An</a><A class="k" HREF=\'/tac-gia/y\'> Bo </A>', "An Bo"),
    ('a[href*="tac-gia"]::attr(title)', False, '<a title="Tú &amp; Hà" href="/tac-gia/x">An</a>', "Tú & Hà"),
    (".author::text", False, '<p class="big author">An</p>', "An"),
    (".author::text", False, '<p class="author-name">An</p>', ""),
    ("div.relative.font-medium::text", False, '<div class="font-medium x relative">An</div>', "An"),
    ("div.relative.font-medium::text", False, '<div class="relative">An</div>', ""),
    (".author-info .name::text", False, '<p class="name">No</p><div class="author-info"><b class="name">An</b></div>', "An"),
    ('[itemprop="author"] [itemprop="name"]::text', False, '<i itemprop="author"><b itemprop="name">An</b></i>', "An"),
    ('p[style*="text-align:right"] strong::text', False, '<p style="x;text-align:right;"><strong>An</strong>', "An"),
    ('p[style*="text-align: right"] strong::text', False, '<P STYLE="text-align: right"><STRONG>An</STRONG></P>', "An"),
    ('div.name a[href*="tac-gia"]::text', False, '<a href="/tac-gia/x">No</a><div class="name"><a href="/tac-gia/y">An</a></div>', "An"),
    (".author-name a::text", False, '<p class="author-name"><a href="x">An</a></p>', "An"),
    ("time::text", False, "<TIME>14:00</TIME>", "14:00"),
    ('[data-role="publishdate"]::text', False, '<i data-role="publishdate">1/2/2024</i>', "1/2/2024"),
    (".bread-crumb__detail-time p::text", False, '<div class="bread-crumb__detail-time"><p>1/2/2024</p></div>', "1/2/2024"),
    ("span.t1::text, span.t2::text", False, '<span class="t2">Hai</span><span class="t1">Một</span>', "Hai"),
    (".news-detail-project *::text", True, '<div class="news-detail-project"><b>An</b> <i>Bo</i></div>', "An Bo"),
    ('meta[name="author"]::attr(content)', False, '<meta content="An" name="author">', "An"),
    ('meta[name="author"]::attr(content)', False, "<meta name='author' content=\"O'Neil\">", "O'Neil"),
    ("time::attr(datetime)", False, '<time class="x" datetime="2024-01-01">', "2024-01-01"),
    ("span.date::text", False, "<b>none</b>", ""),
    ("p.t-a-r strong::text", False, '<p class="t-a-r">x</p><p><strong>Outside</strong></p>', ""),
    (".author-info .name::text", False, '<div class="author-info"></div><div class="menu"><span class="name">Menu</span></div>', ""),
    (".author-info .name::text", False, '<div class="author-info"><div>x</div><span class="name">An</span></div>', "An"),
    (".author::text", False, '<div class="author"><b>By</b> Lan Anh</div>', " Lan Anh"),
    (".author::text", False, "<i class=author>An</i>", "An"),
    (".author::text", False, '<p class="author"><br>An', "An"),
    (".news-detail-project *::text", True, '<div class="news-detail-project">No<b>An</b></div><i>No</i>', "An"),
    ("time::attr(datetime)", False, "<time datetime=2024-01-01>", "2024-01-01"),
    (".author::text", False, '<p title="a > b" class="author">An</p>', "An"),
    (".author::text", False, "<p title='1 > 0' data-x=\"'>\" class=author>An</p>", "An"),
    (".author::text", False, '<p title="open>No</p><p class=author>An</p>', "An"),
    (".author::text", False, '<p title="open class=author>No</p><p class="author">An</p>', ""),
    (".author::text", False, "<p class=author data-q=it's>An</p>", "An"),
    (".author::text", False, "1 < 2 <p class=author>a < b > c</p>", "a < b > c"),
    (".author::text", False, '<ul><li class="author">An<li>No</ul>', "An"),
    (".author::text", False, '<p class="author">&rsquo;An&#146; &#150; &bigstar;</p>', "\u2019An\u2019 \u2013 \u2605"),
    (".author-info .name::text", False, '<p class="author-info">x<div><b class="name">No</b></div>', ""),
    (".author-info .name::text", False, '<div class="author-info"><p>x</div><b class="name">No</b>', ""),
    (".author-info .name::text", False, '<b class="author-info">x</i></p><i class="name">An</i></b>', "An"),
    ('a[href*="tac-gia"]::attr(title)', False, '<a href="/tac-gia/x">An</a><a title="Hà" HREF="/tac-gia/y" href="/z">Hà</a>', "Hà"),
    (".author::text", False, '<p class="author">B&#7843;o &#x1ECD; &ecirc;&amp;lt; &hellip; &none; &#xD800; &', "Bảo ọ ê&lt; … &none; \ufffd &"),
]


def test_rules(spark):
    """Every rule on its page, in one pass per rule."""
    rules = list(dict.fromkeys(Rule(selector, every) for selector, every, *_ in RULES))
    pages = spark.createDataFrame([(i, "u", html) for i, (_, _, html, _) in enumerate(RULES)], PAGE)
    found = markup.candidates(Page(), tuple(rules))
    got = {r["page_id"]: r["found"] for r in art.visible_pages(pages).select("page_id", found.alias("found")).collect()}
    for i, (selector, every, html, expected) in enumerate(RULES):
        assert got[i][rules.index(Rule(selector, every))] == expected, (selector, html)


def test_rule_counts():
    assert len(markup.AUTHOR_RULES) == 28 and len(markup.DATE_RULES) == 13


def test_main_text(spark):
    html = ("<title>T &amp; U</title><body><nav>menu</nav><article><script>p('<p>')</script><h1>Head</h1><p>one<br>two <b>x</b>"
            "<p>&nbsp;<p>three<!-- no --></article>footer</body>")
    assert one(spark, html, markup.main_text) == "Head\n\none\n\ntwo x\n\nthree"
    assert one(spark, html, markup.page_title) == "T & U"


def authors(spark, pages):
    """The author of each page, in one pass."""
    rows = spark.createDataFrame([(i, "https://d/x.html", html) for i, html in enumerate(pages)], PAGE)
    return [r["author"] for r in art.page_authors(art.visible_pages(rows)).orderBy("page_id").collect()]


META = '<meta name="author" content="{}">'
RULE = '<p class="author">Thu Trang</p>'
TAIL = "<article><p>text</p><p>Theo: Reuters</p><p><i>last</i></p></article>"
FILLER = "<p>x x x x x x x x</p>" * 14
NESTED = '<div class="right"><p>a </p><div><b>Lan Anh</b></div></div>'
FOOT = "<footer><p><b>Contact Us</b></p></footer>"
AUTHORS = [
    # the order of byline, rules, closing blocks, parked name and metadata
    (META.format("Lan Anh") + RULE, "Lan Anh"),
    (META.format("Báo Dân trí") + RULE, "Thu Trang"),
    (META.format("Báo Dân trí") + TAIL, "Reuters"),
    (META.format("Báo Dân trí"), "Báo Dân trí"),
    ('<meta property="article:author" content=" Hà ">', "Hà"),
    ('<p class="author">15/12</p>', "Unknown"),
    ('<p class="author">- An • 12/3</p>', "An"),
    ('<p class="author">An hotline: 0912 345 678</p>', "An"),
    # the last fifteen blocks, backwards
    (f"<article><p><b>Thu Trang</b></p>{FILLER}</article>", "Thu Trang"),
    (f"<article><p><b>Thu Trang</b></p><p>y</p>{FILLER}</article>", "Unknown"),
    ('<article><p><b>Thu Trang</b></p><div class="author-box">Minh Hà</div><div style="text-align:right">Lan Anh</div></article>', "Lan Anh"),
    # whole blocks of the content area
    (f"<article>{NESTED}</article>", "a Lan Anh"),
    ("<article><p><b>Lan</b><i> Anh</i></p></article>", "Lan Anh"),
    (f'<div class="main-content"><p><b>Lan Anh</b></p></div>{FOOT}', "Lan Anh"),
    (f'<div class="main-content"><p>text</p></div>{FOOT}', "Unknown"),
    ("<p><b>Lan Anh</b></p>", "Lan Anh"),
]


def test_authors(spark):
    found = authors(spark, [html for html, _ in AUTHORS])
    assert [(html, author) for (html, _), author in zip(AUTHORS, found)] == AUTHORS


def test_links_are_read_from_visible_markup(spark):
    html = ("<!-- <a href='/no'> --><script>'<a href=\"/no\">'</script><a href=/unq.html>x</a><A HREF='/x?a=1&amp;b=2'>"
            '<a href=" /lead.html"><a name="none">')
    pages = spark.createDataFrame([(1, "https://a.b/c/d", html)], PAGE)
    found = links.resolved_links(links.raw_links(pages)).orderBy("position").collect()
    assert [r["href"] for r in found] == ["/unq.html", "/x?a=1&b=2", " /lead.html"]
    assert [r["dst_url"] for r in found] == ["https://a.b/unq.html", "https://a.b/x?a=1&b=2", "https://a.b/lead.html"]


def test_date_from_the_address(spark):
    pages = spark.createDataFrame([
        (1, "https://d/2024/05/17/x.html", "<p>x"), (2, "https://d/2024/13/17/x.html", "<p>x"),
        (3, "https://d/2024/05/17/x.html", "<time>6/4/2026</time>")], PAGE)
    assert {r["page_id"]: r["publish_date"] for r in art.page_dates(art.visible_pages(pages)).collect()} == {
        1: "2024-05-17 00:00:00", 2: "Unknown", 3: "2026-04-06 00:00:00"}


def test_extract_articles(spark):
    """Scripts and comments hold no author, date or text of the page."""
    html = "<!-- <p class='author'>No One</p> --><script>'<time datetime=\"2001-01-01T00:00\">'</script><title> T </title><article><p>" + "a" * 100 + '</p><time datetime="2026-04-06T19:33">x</time></article>'
    pages = spark.createDataFrame([(1, "https://d:80/x.html", html), (2, "https://d/y.html", "<p>short</p>")],
                                  PAGE)
    rows = art.extract_articles(pages).collect()
    assert [r.asDict() for r in rows] == [{
        "title": "T", "content": "a" * 100 + "\n\nx", "url": "https://d:80/x.html", "source": "d:80",
        "author": "Unknown", "publish_date": "2026-04-06 19:33:00"}]


def test_tags_end_outside_of_quotes(spark):
    """A > in a quoted value ends no tag; a quote without its like is a character."""
    html = ("<a title=\"a > b\" href=\"/q.html\">x</a><a href='/r.html' title='1 > 0'>y</a><A\nHREF = /s.html>z</A>"
            "<p data-x=\"<a href='/no'>\">t</p><abbr href=/no2>n</abbr><a data-href=/no3>n</a><a href=\"/t.html>u</a>")
    pages = spark.createDataFrame([(1, "https://a.b/c/d", html)], PAGE)
    found = [r["href"] for r in links.raw_links(pages).orderBy("position").collect()]
    assert found == ["/q.html", "/r.html", "/s.html"]


def plain_ends(names):
    """For each opening tag the place of its end, by looking at every tag behind it, for well formed markup."""
    ends = {}
    for at, name in enumerate(names):
        if name and not name.startswith("/"):
            depth = 0
            for later in range(at, len(names)):
                depth += (names[later] == name) - (names[later] == "/" + name)
                if depth == 0:
                    ends[at] = later
                    break
    return ends


def test_element_table_of_nested_markup():
    import random

    rng = random.Random(3)

    def made(depth):
        name = rng.choice(["div", "b", "span", "section", "i"])
        return f"<{name}>" + "".join(made(depth + 1) if rng.random() < 0.6 else "t" for _ in range(rng.randrange(4) if depth < 6 else 0)) + f"</{name}>"

    for _ in range(50):
        names, texts, attrs, ends, owners, places = elements.element_table("x" + made(0) + made(0))
        assert {at: ends[at] for at in plain_ends(names)} == plain_ends(names)
        assert ends[0] == len(names) == len(texts) == len(attrs) == len(ends) == len(owners)
        for at, owner in enumerate(owners):
            around = [e for e in (0, *plain_ends(names)) if e <= at < ends[e]]
            assert owner == max(around)
        assert places["*"] == sorted(plain_ends(names))


def test_broken_markup_costs_no_more():
    """Time of the table grows with the page, also where nothing is closed or tags and quotes do not end."""
    import time

    shapes = ["<b>", "</b>", "<div><p>", "<p a='", '<a href="x"', "<a =", "<li>x", "a<", "<i a=b c='d' e>t</i>", "<x " + "y" * 50, "<b></div>"]
    for shape in shapes:
        took = []
        for count in (2_000, 20_000):
            start = time.perf_counter()
            elements.element_table(shape * count)
            took.append(time.perf_counter() - start)
        assert took[1] < 40 * took[0] + 0.2, (shape, took)


def test_odd_pages(spark):
    """Null, empty and huge pages, and pages without markup."""
    pages = spark.createDataFrame([(1, "https://d/x", None), (2, None, ""), (3, "https://d/2024/01/02/y", "no markup"),
                                   (4, "u", "<p class=author>An</p>" + "<p>word</p>" * 20_000)], PAGE)
    rows = {r["page_id"]: r for r in art.page_dates(art.page_authors(art.page_texts(art.visible_pages(pages)))).collect()}
    assert [rows[i]["title"] for i in (1, 2, 3, 4)] == [""] * 4
    assert [rows[i]["text"] for i in (1, 2, 3)] == ["", "", "no markup"] and len(rows[4]["text"]) == 2 + 20_000 * 6
    assert [rows[i]["author"] for i in (1, 2, 3, 4)] == ["Unknown", "Unknown", "Unknown", "An"]
    assert rows[3]["publish_date"] == "2024-01-02 00:00:00" and links.raw_links(pages).count() == 0
    assert art.extract_articles(pages.limit(0)).collect() == []
