from __future__ import annotations

import html
import re
import tracemalloc
from collections import Counter

from blotter.llm.html_text import best, candidates, extract, extract_pages, parse, vote

from .conftest import SF_MID

PAGES = "page_id long, url string, html string"


def plain(page):
    """The article of the tables' own template, by a direct regular expression."""
    m = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    if not m:
        return ""
    body = re.sub(r"<[^>]*$", "", m.group(1))
    blocks = re.split(r"</?(?:p|h1)>", body)
    out = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
    return "\n".join(b for b in out if b)


def test_whole_small_table_against_the_template(spark):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    truth = {r.page_id: plain(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in extract_pages(pages).collect()} == truth


ARTICLE = ("<html><body><header>Site name</header><nav><ul><li><a href=/a>Home</a></ul></nav>"
           "<div class='cookie-notice'>We use cookies</div><div id=wrap12><div class='post p-34'><h1>A &amp; B</h1>"
           "<p>One   two\n three<p>Four <b>five</b> s<i>i</i>x &lt;seven&gt;<div class=ad>Buy</div>"
           "<script>var x = '<p>no</p>';</script><ul><li>Eight<li>Nine</ul><form><p>Name</p></form></div>"
           "<section class=comments><p>" + "Reader says a lot. " * 40 + "</p></section></div><aside><p>Side</p></aside>"
           "<footer><p>Foot</p></footer></body></html>")


def test_boilerplate_unclosed_elements_and_references():
    assert extract(ARTICLE, None) == "A & B\nOne two three\nFour five six <seven>\nEight\nNine"
    assert vote(ARTICLE)[0].endswith("/div/div.p-#.post")
    assert best(parse(ARTICLE)).tag == "div"


def test_split_article_meets_in_its_parent():
    page = "<body><article><section><p>" + "a " * 50 + "</p></section><section><p>" + "b " * 50 + "</p></section></article></body>"
    assert extract(page, None).split("\n") == [("a " * 50).strip(), ("b " * 50).strip()]


def test_wrappers_with_boilerplate_words_keep_the_article():
    story = "<h1>Title</h1><p>" + "Story words. " * 20 + "</p>"
    want = "Title\n" + ("Story words. " * 20).strip()
    rest = "<div class=sidebar><p>Side</p></div><section class=comments><p>Reader</p></section>"
    for tag in ("div class='layout with-sidebar'", "div class=has-sidebar", "div class=no-sidebar", "div id='main-nav-open'",
                "section class='search-result'", "form id=aspnetForm"):
        for inner in (f"<article>{story}</article>", f"<div class=post>{story}</div>"):
            name = tag.split()[0]
            assert extract(f"<body><p>Tagline</p><{tag}>{inner}{rest}</{name}><footer><p>Foot</p></footer></body>", None) == want, tag
    short = "<body><div class=text><p>Short.</p></div><div class=cookie-notice><p>" + "We use cookies. " * 40 + "</p></div></body>"
    assert extract(short, None) == "Short."
    both = ("<body><div id=main-nav-open><p>Short.</p></div><section class=comments><p>" + "Reader. " * 40 + "</p></section></body>")
    assert extract(both, None) == "Short."
    replies = "<body><article><p>Short.</p></article><section class=comments><article><p>" + "Reader. " * 40 + "</p></article></section></body>"
    assert extract(replies, None) == "Short."


def test_heading_classes_paragraph_words_and_inline_elements_stay():
    page = ("<article><h1 class='page-header'>One</h1><div class='article-header'><h2>Two</h2></div><p class=notice>Three</p>"
            "<p class=share>Four</p><p>Five <math><mi>x</mi></math> <svg><text>six</text></svg> <button>seven</button></p>"
            "<dialog><p>Eight</p></dialog><p class=ad>Buy</p><div class=share><p>Share</p></div></article>")
    assert extract(page, None) == "One\nTwo\nThree\nFour\nFive x six seven\nEight"


def test_title_and_body_box_give_the_whole_article():
    body = "<p>" + "Long text here. " * 200 + "</p>"
    want = "Title\nLead\n" + ("Long text here. " * 200).strip() + "\nClosing"
    for tag in ("article", "main", "div class=post", "body"):
        inner = f"<{tag}><h1>Title</h1><p>Lead</p><div class=text>{body}</div><p>Closing</p></{tag.split()[0]}>"
        page = inner if tag == "body" else f"<body><nav><a href=/>Home</a></nav>{inner}<div class=box><p>Other</p></div></body>"
        assert extract(page, None) == want, tag
        assert vote(page)[0].split("/")[-1] == tag.replace(" class=", ".")
    split = f"<body><div class=post><div class=top><h1>Title</h1><p>Lead</p></div><div class=text>{body}</div><div><p>Closing</p></div></div></body>"
    assert extract(split, None) == want
    links = f"<body><div class=wrap><ul><li><a href=/a>Home page</a></li></ul><div class=text>{body}</div></div></body>"
    assert extract(links, None) == ("Long text here. " * 200).strip()


def test_edge_cases(spark):
    long_page = "<article>" + "<p>word</p>" * 20000 + "</article>"
    deep = "<div>" * 3000 + "<p>in</p>"
    rows = [(1, "http://h/x", None), (2, "http://h/y", ""), (3, None, "<article><p>No host</p></article>"),
            (4, "http://H:80/z", "plain text only"), (5, "http://h/l", long_page), (6, "http://h/d", deep),
            (7, "http://h/c", "<article><p>Cut of</p><p>he"), (7, "http://h/c", "<article><p>Cut of</p><p>he"),
            (None, "http://h/n", "<article><p>No id</p></article>"), (8, "http://h/t", "<article><p>Tag</p><foot")]
    got = [(r.page_id, r.text) for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()]
    assert sorted(got, key=str) == sorted([(1, ""), (2, ""), (3, "No host"), (4, "plain text only"),
                                           (5, "\n".join(["word"] * 20000)), (6, "in"), (7, "Cut of\nhe"), (7, "Cut of\nhe"),
                                           (None, "No id"), (8, "Tag")], key=str)
    assert extract_pages(spark.createDataFrame([], PAGES)).count() == 0
    clash = spark.createDataFrame(rows[:3], PAGES).selectExpr("*", "1 as host", "2 as paths", "3 as text", "4 as score")
    assert extract_pages(clash).count() == 3


def test_host_consensus_overrules_one_odd_page(spark):
    normal = "<body><div class=main-text><p>" + "Story words here. " * 20 + "</p></div><div class=box><p>x</p></div></body>"
    odd = "<body><div class=main-text><p>Short story.</p></div><div class=box><p>" + "Listing of things. " * 20 + "</p></div></body>"
    rows = [(i, "http://h/" + str(i), normal) for i in range(5)] + [(9, "http://h/9", odd), (10, "http://other/9", odd)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[9] == "Short story." and got[10].startswith("Listing")


def test_every_template_of_a_host_keeps_its_votes(spark):
    side = "<div class=teaser><p>Teaser text on every page.</p></div>"
    names = "red blue green gold pink grey black white".split()
    rows, want = [], {}
    for k, name in enumerate(names):
        for i in range(3 + 4 * (len(names) - k)):
            text = f"{name} story words. " * 20
            rows.append((len(rows), "http://h/x", f"<body><div class='text category-{name}'><p>{text}</p><p>{i}</p></div>{side}</body>"))
            want[rows[-1][0]] = f"{text.strip()}\n{i}"
    for i in range(60):  # a generic winner, and the shared side box
        rows.append((len(rows), "http://h/y", f"<body><p>Loose {i} {'words ' * 30}</p>{'<p>more</p>' * 5}{side}</body>"))
        rows.append((len(rows), "http://h/z", f"<body>{side}<p>{i}</p></body>"))
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()}
    assert {k: got[k] for k in want} == want


def test_votes_decide_on_the_tables_pages_with_long_listings(spark):
    """Every fifth page gets a listing longer than its article: alone it is
    read wrong, by the votes of a host with enough other pages it is read right."""
    rows, want, odd = [], {}, set()
    for r in spark.read.parquet(f"{SF_MID}/pages.parquet").orderBy("page_id").collect():
        text = r.html
        if len(rows) % 5 == 0 and "</article>" in text:
            odd.add(len(rows))
            text = text.replace("</article>", "</article><div class=listing>" + "<p>Other things to read on this site.</p>"
                                * (len(text) // 20) + "</div>", 1)
        want[len(rows)] = plain(text)
        rows.append((len(rows), r.url, text))
    alone = {i: extract(text, None) for i, _, text in rows}
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()}
    # hosts where the pages without a listing are twice as many as those with one
    host = {i: re.sub(r"^\w+://([^/]*).*", r"\1", url or "") for i, url, _ in rows}
    pages, odds = Counter(host.values()), Counter(host[i] for i in odd)
    clear = {i for i in host if pages[host[i]] >= 3 * odds[host[i]]}
    assert len(clear & odd) >= 15 and all(alone[i] != want[i] for i in odd)
    assert {i: got[i] for i in clear} == {i: want[i] for i in clear}


def test_deep_pages_take_memory_in_proportion_to_their_length():
    for page in ("<div>" * 200_000 + "<p>in</p>", "<div>ab" * 140_000, "<b><p>x" * 140_000,
                 "<div>" * 100_000 + "</section>" * 50_000):
        tracemalloc.start()
        found = candidates(page)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200 << 20 and all(len(f[0]) <= 16 for f in found)
    assert extract("<div>" * 200_000 + "<p>in</p>", None) == "in"
