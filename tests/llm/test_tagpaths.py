from __future__ import annotations

import html
import re

from tidemark.llm import catalog, tagpaths
from tidemark.llm.tagpaths import main_text

PAGE = """<!DOCTYPE html><html><head><title>Off &amp; on</title><style>p{{}}</style><script>var a="</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>The Site</h1></header><div id="cookie-notice">We use cookies, fine.</div>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy, buy. Now!</div>{}
<aside>Side, with text.</aside><form>Mail <input> <button>Go</button></form>
<section id="comments"><p>I think, that this is a long comment, really; it is.</p></section>
<footer>&copy; someone, somewhere.</footer></body></html>"""


def test_query_gives_the_articles(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = catalog.op3_tag_path_ratios(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r.page_id].html
        article = page[page.index("<article>") + 9 : page.index("</article>")]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def test_an_article_element_is_kept_whole_and_nothing_else():
    article = '<article><h1>A title</h1><p>First&nbsp;para, it\n is  &lt;here&gt;.<p>Short<ul><li>one<li>two</ul><div class="share">Share!</div><blockquote>Said <b>bo</b>ld<br>so.</blockquote></article>'
    assert main_text(PAGE.format(article)) == "A title\nFirst para, it is <here>.\nShort\none\ntwo\nSaid bold so."


def test_names_of_other_attributes_do_not_count():
    page = '<article><div class="article-header"><h1>Head</h1></div><p data-id="comment-3">One, two.</p><ol class="commentlist"><li>No, no.</ol></article>'
    assert main_text(page) == "Head\nOne, two."


def test_ratios_find_the_section_of_a_page_without_an_article():
    body = "".join(f"<p>Sentence number {i}, which is long enough, has some marks; and it ends here.</p>" for i in range(6))
    links = "".join(f"<div><a href=x>Link {i}</a></div>" for i in range(9))
    page = f"<body><div>{links}</div><div><h2>Title</h2><div class=text>{body}<p>Short</p></div></div><div>Copyright</div></body>"
    found = main_text(page).split("\n")
    assert found[0] == "Title" and found[-1] == "Short" and len(found) == 8


def test_broken_and_odd_markup():
    assert main_text("") == "" and main_text("<html><body><script>only") == ""
    assert main_text("plain text, no tags.") == "plain text, no tags."
    assert main_text("a < b and c > d") == "a < b and c > d"
    assert main_text("<p>one<!-- <p>no --><p>two <![CDATA[no]]>&#x41;&amp;amp;<p hidden>gone</p>") == "one\ntwo A&amp;"
    assert main_text("<p title='a>b'>x</div></p></article>y") == "x\ny"
    assert main_text("<p>" * 3000 + "deep, text.") == "deep, text."
    assert main_text("<div>" * 3000 + "deep, text.") == "deep, text."


def test_null_long_and_repeated_pages(spark):
    long = "<article>" + "<p>Some words, again.</p>" * 30_000 + "</article>"
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", None, 1, "x"), (2, None, "", 1, "x"), (None, "u", "<p>a</p>", 1, "x"), (3, "u", long, 1, "x"), (3, "u", long, 1, "x")]
    found = tagpaths.extracted(spark.createDataFrame(rows, schema)).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in found[:3]] == [(1, "u", 0), (2, None, 0), (None, "u", 1)]
    assert [r.text.count("\n") for r in found[3:]] == [29_999] * 2
    assert tagpaths.extracted(spark.createDataFrame([], schema)).collect() == []


BODY = "".join(f"<p>Sentence number {i}, which is long enough, has some marks; and it ends here.</p>" for i in range(6))
BODY_TEXT = "\n".join(f"Sentence number {i}, which is long enough, has some marks; and it ends here." for i in range(6))
ROUND = "<nav><a href=x>Home</a></nav><div>{}</div><div class=sidebar><p>Buy this, now. It is good.</p></div><footer>All rights reserved, here.</footer>"


def test_names_and_forms_around_the_text_do_not_take_it_away():
    wrappers = [
        "<form id=aspnetForm>{}</form>", "<form><fieldset>{}</fieldset></form>", "<div class='page has-sidebar'>{}</div>",
        "<div id='main-with-comments'>{}</div>", "<div class='site no-header'>{}</div>", "<article class='post author-jane'>{}</article>",
        "<article class='ad-free'>{}</article>", "<div class='post author-jane'>{}</div>", "<div class=sidebar>{}</div>",
        "<main><div class='post author-jane'>{}</div></main>", "<form><div class='post author-jane'>{}</div></form>",
    ]
    for wrapper in wrappers:
        for inner in (BODY, f"<article>{BODY}</article>", f"<main>{BODY}</main>"):
            assert main_text(f"<body>{wrapper.format(inner)}</body>") == BODY_TEXT, wrapper
            found = main_text("<body>" + ROUND.format(wrapper.format(inner)) + "</body>")
            if "class=sidebar" not in wrapper:
                assert found == BODY_TEXT, wrapper
        assert main_text(f"<body>{wrapper.format(ROUND.format(BODY))}</body>") == BODY_TEXT, wrapper


def test_long_comments_stay_aside_and_small_asides_in_a_form_too():
    comments = "<div class='post-comments'>" + "<article><p>I think, that this is long; really.</p></article>" * 60 + "</div>"
    assert main_text(f"<body><article>{BODY}</article>{comments}</body>") == BODY_TEXT
    assert main_text(f"<body><div class=text>{BODY}</div>{comments}</body>") == BODY_TEXT
    assert main_text(f"<form>{BODY}<label>Name, please.</label><div class=related-links><p>More, here.</p></div></form>") == BODY_TEXT


def test_self_closed_svg_and_math_are_empty():
    for empty in ("<svg/>", "<svg class='icon' />", '<math a="b"/>', "<svg focusable/>"):
        assert main_text(f"<article><p>One, two.</p>{empty}<p>Three, four.</p></article>") == "One, two.\nThree, four.", empty
    assert main_text("<article><p>One, <svg><text>no</text></svg>two.</p></article>") == "One, two."
    assert main_text("<article><p>One, <span hidden>x, y.</span>two.</p></article>") == "One, two."


def test_a_page_without_an_article_keeps_leads_tables_code_and_captions():
    long = "".join(f"<p>{f'Paragraph {i} goes on and on, with many words, some marks; and more of it. ' * 7}</p>" for i in range(6))
    lead = "<div class=lead><p>A lead of about a hundred and fifty characters, which is what a neighbouring path may have, stands here. It is a part of the article, too.</p></div>"
    extra = "<table><tr><td>Alpha<td>12<tr><td>Beta<td>13</table><div class=code><pre>x = 1</pre></div><div class=caption>A caption</div>"
    menu = "".join(f"<div><a href=x>Link {i}</a></div>" for i in range(9))
    wanted = ["A lead", "Paragraph 0", "Paragraph 5", "Alpha", "12", "Beta", "13", "x = 1", "A caption"]
    pages = [
        f"<body><div class=links>{menu}</div><div class=text>{lead}{long}{extra}</div><div>Copyright</div></body>",
        f"<body><div class=links>{menu}</div><div class=page>{lead}{extra}<div class=text>{long}</div><div class=links>{menu}</div></div><div>Copyright</div></body>",
        f"<body><div class=links>{menu}</div>{lead}{extra}<div class=text>{long}</div><div>Copyright</div></body>",
    ]
    for page in pages:
        found = main_text(page)
        assert all(f"\n{start}" in f"\n{found}" for start in wanted), found
        assert "Link" not in found and "Copyright" not in found


def test_leads_and_tails_beside_the_only_text_section_are_kept():
    long = "".join(f"<p>{f'Paragraph {i} goes on and on, with many words, some marks; and more of it. ' * 5}</p>" for i in range(5))
    lead, tail = "Lead, short.", "A tail of one sentence, which closes all that was said before it."
    inner = f"<div class=intro>{lead}</div><div class=text>{long}</div><div class=more>{tail}</div>"
    around = [
        "<body><div id=wrap>{}</div></body>", "<body><nav>Home, now.</nav><section>{}</section><footer>All rights, here.</footer></body>",
        "<body><div><div id=wrap>{}</div></div><div>Copyright</div></body>", "<div class=page><center>{}</center></div>",
        "<table><tr><td><a href=x>Home</a></td><td>{}</td></tr></table>", "<body><ul><li><a href=x>Home</a></ul><div>{}</div></body>",
        "<body><div class=sidebar>Buy, now.</div><div class=col>{}</div></body>", "<form><div>{}</div></form>",
    ]
    inners = [
        inner, inner.replace("<div class=text>", "<div class=outer><div class=text>").replace("</div><div class=more>", "</div></div><div class=more>"),
        f"<p class=intro>{lead}</p><div class=text>{long}</div><p>{tail}</p>", f"{lead}<div class=text>{long}</div>{tail}",
    ]
    for page in around:
        for one in inners:
            found = main_text(page.format(one)).split("\n")
            assert (found[0], found[-1], len(found)) == (lead, tail, 7), (page, one[:60], found)


def test_text_without_sentences_beside_the_text_does_not_widen_it():
    long = "".join(f"<p>{f'Paragraph {i} goes on and on, with many words, some marks; and more of it. ' * 5}</p>" for i in range(5))
    page = f"<body><div><div>Copyright</div><div class=text>{long}</div><div><a href=x>More, to read.</a></div></div></body>"
    assert len(main_text(page).split("\n")) == 5


def test_names_do_not_take_a_paragraph_of_an_article_away():
    for kind in ("teaser", "meta lead", "byline", "post-header"):
        assert main_text(f"<article><p class='{kind}'>What it is about.</p>{BODY}</article>") == f"What it is about.\n{BODY_TEXT}", kind
        assert main_text(f"<body><div><p class='{kind}'>What it is about.</p>{BODY}</div></body>") == f"What it is about.\n{BODY_TEXT}", kind
    for kind in ("ad", "cookie-notice", "share", "comment"):
        assert main_text(f"<article><p class='{kind}'>What it is about.</p>{BODY}</article>") == BODY_TEXT, kind


def test_cells_and_rows_of_a_layout_table_are_told_apart():
    menu = "<a href=x>Home</a><br><a href=x>About</a>"
    pages = [
        f"<table><tr><td>{menu}</td><td>{BODY}</td></tr></table>", f"<table><tr><td>{menu}</td></tr><tr><td>{BODY}</td></tr></table>",
        f"<table><tr><td>{menu}<td>{BODY}<td>{menu}</table>", f"<table><tr><td colspan=2>{menu}<tr><td>{menu}<td>{BODY}<tr><td>Imprint</table>",
        f"<table><tbody><tr><td>{menu}</td><td><div>{BODY}</div></td></tr></tbody></table>",
    ]
    for page in pages:
        assert main_text(page) == BODY_TEXT, page
    data = "<table>" + "".join(f"<tr><td>Row {i}<td>{i}" for i in range(9)) + "</table>"
    assert main_text(f"<body><div>{BODY}{data}</div></body>").count("\n") == 5 + 18
    assert main_text(f"<article>{BODY}{data}</article>").count("\n") == 5 + 18


def test_an_empty_table_of_pages(spark):
    schema = "page_id long, url string, html string"
    assert tagpaths.extracted(spark.createDataFrame([], schema)).schema.names == ["page_id", "url", "text", "n_chars"]
