"""Pages whose attributes, names and places used to cost text of the article."""

import pytest

from termspark.llm import html_text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div style=\"overflow:hidden\"><p>one, two</p></div>", "one, two"),
        ("<p title=\"A hidden gem\">one, two</p>", "one, two"),
        ("<div data-hidden=\"false\"><p>one, two</p></div>", "one, two"),
        ("<p>to <a href=\"/hidden-lake\">the lake</a></p>", "to the lake"),
        ("<p>to <a href=\"/a?id=comments\">them</a></p>", "to them"),
        ("<div><p>one, two</p><p hidden>three</p><p aria-hidden=true>four</p><p class='ad'>five</p></div>", "one, two"),
    ],
)
def test_attributes(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize(
    "part",
    [
        "<section id='discussion'><p>{}</p></section>",
        "<section id='related-work'><p>{}</p></section>",
        "<h2 id='search-results'>{}</h2>",
        "<h2 id='login-form'>{}</h2>",
        "<div class='entry-header'><h1>{}</h1></div>",
        "<h2 class='section-header'>{}</h2>",
        "<p class='margin-bottom'>{}</p>",
    ],
)
def test_names_inside_the_article(part):
    page = "<article><p>one, two</p>" + part.format("kept, text") + "<div class='share'><a href=x>Share</a></div>"
    page += "<div class='ad'>Buy, buy</div><div class='cookie-notice'>We use cookies</div></article>"
    assert html_text.extract(page) == "one, two\nkept, text"


LONG = "<p>" + "long text, with commas, and more, " * 9 + "end</p>"
LINKS = "<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>"


@pytest.mark.parametrize(
    "page, parts",
    [
        (f"<body><h1>Title</h1><div>{LONG}</div><p>Short end.</p></body>", ["Title", LONG, "Short end."]),
        (f"<body><p>Intro.</p><div>{LONG}</div><h2>Next</h2><div>{LONG}</div></body>", ["Intro.", LONG, "Next", LONG]),
        (f"<body>{LINKS}<h1>Title</h1><div>{LONG}</div>{LINKS}</body>", ["Title", LONG]),
        (f"<article>{LONG}{LINKS}{LONG}</article>", [LONG, "one", "two", "three", LONG]),
        (f"<article>{LONG}<h2>Sources</h2>{LINKS}</article>", [LONG, "Sources", "one", "two", "three"]),
        (f"<article><h1>Title</h1>{LINKS}{LONG}{LINKS}</article>", ["Title", LONG]),
    ],
)
def test_text_beside_the_best(page, parts):
    wanted = [p.removeprefix("<p>").removesuffix("</p>") for p in parts]
    assert html_text.extract(page).split("\n") == wanted


SHORT = "<p>Short article, of few words.</p>"
CROWD = "".join(f"<div class='comment'><b>Ann {i}</b>{LONG}</div>" for i in range(4))


@pytest.mark.parametrize(
    "page, parts",
    [
        # one listed word in a wrapper's name
        (f"<body><div class='search-result-article'>{LONG}</div></body>", [LONG]),
        (f"<body><div class='header-layout'><h1>Title</h1>{LONG}</div><div class='page-footer'>About us</div></body>",
         ["Title", LONG]),
        (f"<body><div class='no-frills sidebar-left-page'><article>{SHORT}</article></div></body>", [SHORT]),
        (f"<body><div class='entry-header'><h1>Title</h1></div><div>{LONG}</div></body>", ["Title", LONG]),
        # such a name still goes where the text is elsewhere
        (f"<body><article>{SHORT}</article><div class='left-sidebar-column'>{LONG}</div></body>", [SHORT]),
        (f"<body><div>{LONG}</div><div class='site-footer'><p>We are a company, of sorts.</p></div></body>", [LONG]),
        # comments of readers
        (f"<article>{SHORT}<section id='comments'>{CROWD}</section></article>", [SHORT]),
        (f"<main>{SHORT}<div class='user-comments'>{CROWD}</div></main>", [SHORT]),
        (f"<article>{SHORT}</article><article class='comment'>{LONG}</article>", [SHORT]),
        (f"<article>{SHORT}<ol class='comment-list'><li>{LONG}</li></ol></article>", [SHORT]),
        (f"<body><div>{SHORT}</div><div class='comments'>{CROWD}</div></body>", [SHORT]),
        # an article about comments
        (f"<article>{LONG}<section id='comments-on-the-law'>{SHORT}</section></article>", [LONG, SHORT]),
        ("<article><pre>x = 1 <span class='comment'># one</span></pre></article>", ["x = 1 # one"]),
    ],
)
def test_names_and_text(page, parts):
    wanted = [html_text.unescape(p.removeprefix("<p>").removesuffix("</p>")) for p in parts]
    assert html_text.extract(page).split("\n") == wanted
