"""Main text of pages with what articles come with: comments, footers, menus, notices, formulas, leads; odd rows of the page operators."""

import pytest

from rastrum.llm import html_text, url_filters

P1 = "The council met on Tuesday, and after three hours of debate, it agreed on the plan, the paper says."
P2 = "Nobody spoke against it, although some members, among them the treasurer, had asked for more time."
BODY = f"<p>{P1}</p><p>{P2}</p>"
WANT = f"{P1}\n\n{P2}"
SAID = "I think, as a reader of many years, that this is a shame, and so does my neighbour, who never writes."


@pytest.mark.parametrize("extra", [
    f'<div class="post-comments"><p>{SAID}</p></div>', f'<div class="comment-body"><p>{SAID}</p></div>', f'<div class="comment-text">{SAID}</div>', f'<section id="article-comments"><div class="entry">{SAID}</div></section>',
    f'<div class="page-footer"><p>{SAID}</p></div>', '<ul class="main-menu"><li>Home, where it starts</li><li>News, and more of them</li></ul>', f'<div class="story-newsletter"><p>{SAID}</p></div>',
    f'<div class="content-notice"><p>{SAID}</p></div>', f'<div class="body-ad">{SAID}</div>', f'<aside><p>{SAID}</p></aside>', f'<div class="sidebar"><p>{SAID}</p></div>', f'<form><p>{SAID}</p></form>',
])
@pytest.mark.parametrize("inside", [True, False])
def test_what_is_no_article_goes(extra, inside):
    page = f'<html><body><div class="article-body">{BODY}{extra}</div></body></html>' if inside else f'<html><body><div id="wrap"><div class="article-body">{BODY}</div>{extra}</div></body></html>'
    assert html_text.main_text(page) == WANT


@pytest.mark.parametrize("outer", ['div class="post has-comments"', 'div class="story comments-open"', 'div class="content with-sidebar"', 'article class="post comments"', 'main id="menu-page"', 'div class="blog no-sidebar"'])
def test_names_that_tell_of_the_page_stay(outer):
    assert html_text.main_text(f"<html><body><{outer}>{BODY}</{outer.split()[0]}></body></html>") == WANT


def test_formulas_are_text():
    page = f"<body><div class='text'><p>The energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation encoding='application/x-tex'>E=mc^2</annotation></math>, as is known.</p>{BODY}</div></body>"
    assert html_text.main_text(page) == f"The energy is E=mc2 , as is known.\n\n{WANT}" or html_text.main_text(page) == f"The energy is E=mc2, as is known.\n\n{WANT}"


def test_a_lead_beside_the_article_stays():
    assert html_text.main_text(f'<body><div id="x"><div class="lead">A short lead</div><div class="article-body">{BODY}</div></div></body>') == f"A short lead\n\n{WANT}"


def test_odd_rows_of_page_operators(spark):
    long = "<div>" * 20_000 + "<p>" + "word, " * 200_000 + "</p>"
    rows = [(1, "http://a.com/x", f"<body>{BODY}</body>"), (1, "http://a.com/x", f"<body>{BODY}</body>"), (None, None, None), (2, "", ""), (3, "no scheme", "just text"), (4, "http://B.net/es/q?x", long), (5, "http://c.net/", "<" * 100_000), (6, "http://d.net/fr/", "&" * 50_000 + "<!--")]
    df = spark.createDataFrame([(*r, "a", 1, True) for r in rows], "page_id long, url string, html string, text string, n_chars int, verdict boolean")
    for name in ("host", "path", "rule", "id", "a", "b", "key"):
        df = df.withColumn(name, df["n_chars"])
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == WANT and by[None] == by[2] == "" and by[3] == "just text" and by[4].count("word,") == 200_000
    judged = url_filters.url_filters(df).collect()
    assert len(judged) == len(rows) and {r["verdict"] for r in judged} <= {"allow", "block"} and {r["page_id"]: r["rule"] for r in judged}[4] == "net/es/"
    for empty in (html_text.extract(df.limit(0)), url_filters.url_filters(df.limit(0))):
        assert empty.collect() == []
