import pytest

from tallyrec.llm.html_text import extract_pages, main_text, page_lines, smoothed

PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href=/a>Menu</a></li></ul></nav><header>Site</header><div class="ad">Buy a lot of things here, now and today.</div>
<article><header><h1>Head &amp;   line</h1></header><p><b>First&nbsp;one<br>goes on<p>Short.<aside>Side</aside><p>Second  &lt;b&gt; paragraph
with words.</p><form><label>Name</label><input></form><div class="comments"><p>I disagree with it all, says a reader.</p></div></article>
<div id="cookie-notice">We use cookies</div><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize(
    "html, text",
    [
        (PAGE, "Head & line\nFirst one goes on\nShort.\nSecond <b> paragraph with words."),
        (None, ""),
        ("", ""),
        ("  \n", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\nb"),
        ("<article>only &amp;amp; here", "only &amp; here"),
        ("<main><p>x</p></main><p>out of it</p>", "x"),
        ("<script>never</script>", ""),
        ("<div hidden>no</div><div>yes</div>", "yes"),
        ("<p>unfinished <b", "unfinished"),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_page_without_article():
    html = (
        "<div id=menu><a>a</a> <a>b</a></div><div class='content'><p>A long text stands here and goes on "
        "for quite a while.</p><p>Short.</p></div><div class=foot><a>x</a></div>"
    )
    assert main_text(html) == "A long text stands here and goes on for quite a while.\nShort."


LONG = "This paragraph of the main text is long and goes on for quite a while, with hardly a tag in it."
CARD = "<article><a href=/x>A card</a> <b>read</b> it</article>"


@pytest.mark.parametrize("before", [True, False])
def test_a_small_article_does_not_hide_the_text_around_it(before):
    body = f"<div id=content><h1>Head</h1><div><p>{LONG}</p></div><div><p>{LONG}</p></div><div><p>Short.</p></div></div>"
    text = main_text(f"<body>{CARD}{body}</body>" if before else f"<body>{body}{CARD}</body>")
    lines = text.split("\n")
    assert [x for x in lines if "card" not in x] == ["Head", LONG, LONG, "Short."]


def test_no_single_card_outweighs_the_text():
    cards = f"<article><p>{LONG}</p><p>More</p></article>" * 8
    text = main_text(f"<body><div id=content><p>{LONG * 3}</p><p>End.</p></div>{cards}</body>").split("\n")
    # the cards weigh more together, so both stay
    assert text == [LONG * 3, "End."] + [LONG, "More"] * 8


def test_the_heavier_article_wins_over_text_outside():
    assert main_text(f"<article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></article><div><p>{LONG}</p></div>") == (
        f"Head\n{LONG}\n{LONG}"
    )


@pytest.mark.parametrize(
    "part",
    [
        '<h2 id="side-effects">Part</h2>',
        '<h2 id="search">Part</h2>',
        '<section id="related-work"><p>Part</p></section>',
        '<div class="article-header"><h1>Part</h1></div>',
        '<p class="social-policy banner_text">Part</p>',
        '<section id="comments-on-method"><p>Part</p></section>',
        '<div class="no-ads has-sidebar"><p>Part</p></div>',
    ],
)
def test_slugs_are_no_marks(part):
    assert "Part" in main_text(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>").split("\n")


@pytest.mark.parametrize(
    "part",
    [
        '<div class="related box"><p>Part</p></div>',
        '<div id="cookie-notice"><p>Part</p></div>',
        '<div class="share_buttons"><p>Part</p></div>',
        '<div role="search"><p>Part</p></div>',
        f'<div class="comments"><p>{LONG}</p><p>Part</p></div>',
        f'<div class="ad"><p>{LONG}</p><p>Part</p></div>',
        f'<section class="related"><p>{LONG}</p><p>Part</p></section>',
        f'<div class="notice"><div id="alert"><p>{LONG}</p><p>Part</p></div></div>',
        f'<div class="sidebar"><p>{LONG}</p></div>',
        # the first or last part of a name
        '<div class="comment-body"><p>Part</p></div>',
        f'<div class="user-comments"><p>{LONG}</p></div>',
        '<div class="ad-box">Part</div>',
        f'<div id="advert-300"><p>{LONG}</p></div>',
        f'<div class="sidebar-left"><p>{LONG}</p></div>',
        '<div id="cookie-message">Part</div>',
        f'<article class="comment"><p>{LONG}</p></article>',
    ],
)
def test_names_are_marks(part):
    assert main_text(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>") == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("part", ['class="sidebar-left"', 'class="cookie-message"', 'id="ad-top"'])
def test_marks_in_main(part):
    assert main_text(f"<main><p>{LONG}</p><p>End</p><div {part}><p>{LONG}</p></div></main>") == f"{LONG}\nEnd"


@pytest.mark.parametrize("name", ["comment", "comment-body depth-1", "related sponsored"])
def test_articles_of_readers_beside_the_post(name):
    post = f'<article class="post comments-open"><p>{LONG}</p><p>{LONG}</p><p>End</p></article>'
    other = f'<article class="{name}"><p>{LONG}</p></article>'
    assert main_text(f"<body>{post}{other}</body>") == f"{LONG}\n{LONG}\nEnd"
    assert main_text(f'<body><article class="{name}"><p>{LONG}</p><p>End</p></article></body>') == f"{LONG}\nEnd"


@pytest.mark.parametrize("name", ["sidebar", "related", "notice", "site-notice", "right-side"])
def test_long_marked_text_beside_the_article(name):
    side = f'<div class="{name}"><p>{LONG}</p></div>'
    assert main_text(f"<body><article><p>{LONG}</p><p>{LONG}</p></article>{side}</body>") == f"{LONG}\n{LONG}"
    assert main_text(f"<body><div id=c><p>{LONG}</p><p>{LONG}</p></div>{side}</body>") == f"{LONG}\n{LONG}"


def test_most_of_the_text_voids_a_mark_without_article():
    assert main_text(f"<div class=no-sidebar><p>{LONG}</p><p>Part</p></div><div class=left-menu>x</div>") == f"{LONG}\nPart"


def test_chunks_do_not_matter(monkeypatch):
    whole = [x.text for x in page_lines(PAGE * 3).lines]
    monkeypatch.setattr("tallyrec.llm.html_text.CHUNK", 1)
    assert [x.text for x in page_lines(PAGE * 3).lines] == whole


def test_smoothing_keeps_a_constant():
    import numpy as np

    assert np.allclose(smoothed(np.full(7, 3.0)), 3)


def test_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<p>é😀</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = extract_pages(df, "page_id", "url", "html").collect()
    assert sorted(((r["page_id"] or 0), r["url"], r["n_chars"]) for r in got if r["url"]) == [
        (0, "v", 2), (1, "u", len(main_text(PAGE))), (1, "u", len(main_text(PAGE)))]
    assert extract_pages(df.limit(0), "page_id", "url", "html").count() == 0


def test_long_page():
    text = "word " * 200_000
    assert main_text(f"<nav>n</nav><article><p>{text}</p><p>end</p></article>") == text.strip() + "\nend"
