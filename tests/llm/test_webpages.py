"""Pages without article elements, and wrappers whose classes name what they hold."""

import pytest

from tallyhouse.llm import webpages

LEAD = "A lead paragraph stands at the top of the page and says what follows below it."
BODY = "The paragraphs of the text go on for some time, and none of them may be lost. " * 4
CELL = "<td>" + "a long cell of the table with many words in it " * 3 + "</td>"
INNER = {
    "table": f"<h1>Title</h1><p>{LEAD}</p><p>{BODY}</p><table><tr>{CELL * 3}</tr><tr>{CELL * 3}</tr></table>",
    "list": f"<h1>Title</h1><p>{LEAD}</p><ul><li>{BODY}</li><li>{BODY}</li></ul><p>end</p>",
    "quote": f"<p>{LEAD}</p><blockquote><div class='q'><p>{BODY}</p></div><p>{BODY}</p></blockquote><p>end</p>",
    "sections": f"<h1>Title</h1><p>{LEAD}</p><section class='a'><h2>One</h2><p>{BODY}</p></section><section class='b'><p>{BODY}</p></section>",
    "boxes": f"<h1>Title</h1><p>{LEAD}</p><div class='part'><p>{BODY}</p></div><div class='part'><p>{BODY}</p></div>",
    "figure": f"<p>{LEAD}</p><figure><figcaption>{BODY}</figcaption></figure><dl><dt>term</dt><dd>{BODY}</dd></dl>",
}


def plain(html):
    return " ".join(webpages._TAG.sub(" ", html).split())


@pytest.mark.parametrize("kind", list(INNER))
def test_pages_of_boxes_are_whole(kind):
    links = "<div class='top'><a href='/'>Home page</a> <a href='/x'>All of the news</a></div>"
    html = f"<html><body>{links}<div class='content'>{INNER[kind]}</div><div class='low'>Imprint of the site</div></body></html>"
    assert webpages.extract(html, None) == plain(INNER[kind])
    best = max(webpages.scores(webpages.blocks_of(html)).items(), key=lambda x: x[1])[0]
    assert webpages.extract(html, best) == plain(INNER[kind])


def test_cells_of_a_layout_table_are_containers():
    html = f"<body><table><tr><td class='left'>Here are links</td><td class='mid'><h1>Title</h1><p>{BODY}</p></td></tr></table></body>"
    assert webpages.extract(html, None) == plain(f"Title {BODY}")


def test_hosts_of_boxes(spark):
    rows = [
        (i, f"http://boxes.example/{i}", f"<body><div class='top'>Shop</div><div class='content'>{html}</div></body>")
        for i, html in enumerate(INNER.values())
    ]
    found = webpages.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert [r["text"] for r in found.orderBy("page_id").collect()] == [plain(html) for html in INNER.values()]


WRAPPERS = {
    "sidebar": "<div class='page-with-sidebar'><article><h1>Title</h1><p>{}</p></article><div class='sidebar'>Other</div></div>",
    "layout": "<div class='layout sidebar-right'><div class='text'><h1>Title</h1><p>{}</p></div><div class='comments'>First!</div></div>",
    "no": "<div class='no_sidebar'><h2>Title</h2><p>{}</p></div>",
    "id": "<h1>Title</h1><div id='content-and-comments'><p>{}</p><ol class='comments'><li>First!</li></ol></div>",
    "main": "<main><h1>Title</h1><div class='header-overlay'><p>{}</p></div></main><div class='promo'>Buy</div>",
    "logo": "<h1>Title</h1><div class='with_menu search-page'><article><p>{}</p></article></div><div>" + "Legal words. " * 20 + "</div>",
    "two": "<div id='page-sidebar'><div class='social-theme'><h1>Title</h1><p>{}</p></div></div>",
}


@pytest.mark.parametrize("kind", list(WRAPPERS))
def test_wrappers_with_noise_words_keep_the_article(kind):
    found = webpages.extract(f"<html><body>{WRAPPERS[kind].format(BODY)}</body></html>", None)
    assert found == plain(BODY if kind == "logo" else f"Title {BODY}")


@pytest.mark.parametrize("box", ["comments", "related", "promo"])
def test_noise_beside_an_article_stays_out(box):
    noise = f"<div class='{box}'><article class='comment'><p>{BODY * 5}</p></article></div>"
    for html in (
        f"<article><h1>Title</h1><p>{BODY}</p></article>{noise}",
        f"<article><h1>Title</h1><p>{BODY}</p>{noise}</article>",
        f"<div class='post'><h1>Title</h1><p>{BODY}</p></div>{noise}",
        f"<article><h1>Title</h1><p>Short.</p></article>{noise}",
    ):
        expected = "Title Short." if "Short." in html else plain(f"Title {BODY}")
        assert webpages.extract(f"<html><body>{html}</body></html>", None) == expected


def test_titles_in_the_header_of_an_article():
    html = f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1><p>by A.</p></header><p>{BODY}</p></article></body>"
    assert webpages.extract(html, None) == plain(f"Title {BODY}")


@pytest.mark.parametrize("name", ["class='social-science'", "class='ad-hoc'", "id='search-results-explained'", "class='notice-of-intent x'"])
@pytest.mark.parametrize("tag", ["div", "p"])
def test_names_that_only_begin_with_a_noise_word(name, tag):
    part = f"<{tag} {name}>{LEAD}</{tag}>"
    html = f"<body><article><h1>Title</h1>{part}<p>{BODY}</p></article></body>"
    assert webpages.extract(html, None) == plain(f"Title {LEAD} {BODY}")


@pytest.mark.parametrize("part", ["<div class='social-links'><a href='/'>Tell your friends about this text on all the networks</a></div>",
                                  "<div class='ad-slot'>Buy this</div>", "<p class='advert'>{}</p>", "<div class='share'>{}</div>",
                                  "<p hidden>{}</p>", "<div hidden='' class='x'><p>{}</p></div>", "<div class='comment-list'><p>{}</p></div>"])
def test_noise_inside_an_article_stays_out(part):
    html = f"<body><article><h1>Title</h1>{part.format(LEAD)}<p>{BODY}</p></article></body>"
    assert webpages.extract(html, None) == plain(f"Title {BODY}")


def test_hidden_is_an_attribute():
    html = f"<body><article><h1>Title</h1><p class='hidden gem' title='hidden'>{LEAD}</p><p>{BODY}</p></article></body>"
    assert webpages.extract(html, None) == plain(f"Title {LEAD} {BODY}")


def test_a_discussion_longer_than_the_post():
    entries = "".join(f"<div class='entry'><p>{BODY}</p></div>" for _ in range(5))
    html = f"<body><div class='post'><h1>Title</h1><p>{BODY}</p></div><div class='discussion'>{entries}</div></body>"
    assert webpages.extract(html, None) == plain(f"Title {BODY}")
