"""Main texts against the known layout of the table, and on odd pages."""

import html
import re
import time

from hetgraph.llm import html_text as H

SF = "/root/testdata/sf0.01"


def known(page):
    """All pages of the table have one article made of headings and paragraphs."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(x for x in parts if x)


def test_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: (r.url, known(r.html)) for r in pages.collect()}
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in H.extract(pages).collect()}
    assert got == {p: (u, t, len(t)) for p, (u, t) in want.items()}


def test_without_marks():
    body = "<div class='story'><h2>T &amp; U</h2>" + "".join(f"<p>{c * 9} word{c} more text here.</p>" for c in "abcdef") + "</div>"
    menu = "<div><ul>" + "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(9)) + "</ul></div>"
    noise = "<div id='cookie-notice'>We use cookies on all of our very long pages, and more.</div><form>Name <input> please</form>"
    comments = "<section class='comments'>" + "<p>first! I think that this is a long reader comment.</p>" * 9 + "</section>"
    page = f"<html><head><title>x</title></head><body>{menu}{noise}<!-- <p>no</p> -->{body}{comments}<footer>Imprint</footer></body></html>"
    assert H.main_text(page) == "\n".join(["T & U", *(f"{c * 9} word{c} more text here." for c in "abcdef")])


def test_odd_pages(spark):
    pages = {
        None: "", "": "", "<<<>>>": "<<<>>>", "plain": "plain", "<p>a<p>b<br>c": "a\nb c", "<article><p>x &lt;y&gt;&nbsp; z</p>tail": "x <y> z\ntail",
        "<article><header><h1>Hi</h1></header><p>t</p><aside>no</aside></article>": "Hi\nt",
        "<script>if (a<b) '</p>'": "", "<p title='a>b'>q</p>": "q", "<p>&#x41;&eacute;&bogus;</p>": "Aé&bogus;",
        "<nav>only<a href=x>menu</a></nav>": "", "<article><p>" + "long " * 100_000 + "</p></article>": ("long " * 100_000).strip(),
    }
    for page, text in pages.items():
        if page:
            assert H.main_text(page) == text, page[:60]
    rows = [(i, None if i % 2 else "u", p) for i, p in enumerate(pages)] + [(None, "u", "plain"), (3, None, "plain"), (3, None, "plain")]
    df = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in H.extract(df).collect())
    assert got == sorted((str(i), str(u), pages[p], len(pages[p])) for i, u, p in rows)
    assert H.extract(df.limit(0)).collect() == []


def test_deep_pages():
    assert H.main_text("<div>" * 20_000 + "deep text") == "deep text"


def paragraphs(word, n=4):
    return [f"{word} number {i} is a sentence of some length, with nothing but plain words in it." for i in range(n)]


def marked_up(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


MENU = "<div><ul>" + "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(9)) + "</ul></div>"
CARDS = "".join(f"<article class=card><a href=/{i}>Another story {i}</a><p>A short teaser.</p></article>" for i in range(6))


def test_several_articles():
    parts = [paragraphs("first", 6), paragraphs("second", 2), paragraphs("third")]
    articles = "".join(f"<article>{marked_up(x)}</article>" for x in parts)
    for page in (f"<body>{MENU}{articles}</body>", f"<body>{MENU}<main>{articles}</main></body>", f"<body>{MENU}<div>{articles}</div></body>"):
        assert H.main_text(page) == "\n".join(sum(parts, []))


def test_story_beside_teaser_cards():
    story = paragraphs("story", 8)
    for page in (f"<div>{marked_up(story)}</div><div>{CARDS}</div>", f"<main><div>{marked_up(story)}</div>{CARDS}</main>", f"<article>{marked_up(story)}</article>{CARDS}"):
        assert H.main_text(f"<body>{MENU}{page}</body>") == "\n".join(story)


def test_article_in_article():
    outer, inner = paragraphs("outer", 3), paragraphs("inner", 9)
    page = f"<article><h1>T</h1>{marked_up(outer)}<div><article>{marked_up(inner)}</article></div></article>"
    assert H.main_text(f"<body>{MENU}{page}</body>") == "\n".join(["T", *outer, *inner])
    page = f"<article><h1>T</h1><div>{marked_up(inner)}</div></article>"
    assert H.main_text(f"<body>{MENU}{page}</body>") == "\n".join(["T", *inner])


def test_names_of_wrappers_and_parts():
    story = paragraphs("story", 8)
    for mark in ("class='content has-sidebar'", "id='page' class='with-menu'", "class='login-required'", "class='social'", "class='sidebar'", "id=comments"):
        assert H.main_text(f"<body>{MENU}<div {mark}>{marked_up(story)}</div></body>") == "\n".join(story), mark
    for mark in ("id='discussion'", "id='related-work'", "class='notice'"):
        own = paragraphs("part", 2)
        page = f"<body>{MENU}<article>{marked_up(story)}<section {mark}>{marked_up(own)}</section></article></body>"
        assert H.main_text(page) == "\n".join(story + own), mark
    links = "".join(f"<li><a href=/{i}>story {i}</a></li>" for i in range(4))
    for out in (f"<ul class='related'>{links}</ul>", f"<div id='share-box'>{links}</div>", "<div class='comment-list'><p>First!</p></div>", "<div class='ad-top'>Buy it</div>"):
        assert H.main_text(f"<body>{MENU}<article>{marked_up(story)}{out}</article></body>") == "\n".join(story), out


def test_math_and_fallbacks():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p><noscript><p>A table.</p></noscript><p><object data=a.svg>A chart.</object></p></article>"
    assert H.main_text(page) == "Let x=1 hold.\nA table.\nA chart."


def test_hostile_pages_take_linear_time():
    """Two megabytes each: tags and quotes without an end, deep nesting, end tags of nothing."""
    size = 2_000_000
    for page, text in (
        ("<a " * (size // 3), None),
        ('<a "' * (size // 4), None),
        ("<div>" * (size // 5) + "deep", "deep"),
        ("<b>" * 100_000 + "bold" + "</x>" * (size // 4), "bold"),
    ):
        start = time.process_time()
        got = H.main_text(page)
        assert time.process_time() - start < 30
        assert text is None or got == text


def test_open_comment_behind_the_last_tag():
    assert H.main_text("<p>one</p> two <!-- three") == "one\ntwo"
    assert H.main_text("<p>1 < 2</p><") == "1 < 2\n<"
    assert H.main_text("<p>one</p><script>var a = 1 < 2") == "one"
