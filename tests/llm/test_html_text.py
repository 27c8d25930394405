from __future__ import annotations

import html
import itertools
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from marlgrid.llm import html_text
from marlgrid.llm.queries import op4_html_text, read

SF = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>My site</h1><a href="/">Home</a></header>
<div class="cookie-notice"><p>We use cookies to make this site better for you, please accept.</p></div>
<div id="wrapper" class="page-with-sidebar">
<aside><p>A long text about the writer, who writes about many things every day.</p></aside>
<div class="post"><h1>Title</h1><p>Short.<p>A long paragraph with a <a href="q">link</a> in
it &amp; much&nbsp;more text, so that it is clear&#33; that this is content.</p>
<ul><li>item one<li>item two</ul><div class="ad">Buy our product, the best on the market.</div>
<pre>x  y
z</pre><script>var p = "</p><p>no text</p>";</script><!-- <p>nor this</p> --><p>Last words.</p></div>
<section id="comments"><div class="comment"><p>I think that this article is wrong and long.</p></div>
</section></div><form><label>Mail</label><button>Send</button></form>
<footer><p>Copyright of somebody who writes long footers for web sites.</p></footer></body></html>"""

TEXT = """Title
Short.
A long paragraph with a link in it & much more text, so that it is clear! that this is content.
item one
item two
x y z
Last words."""


def test_page():
    assert html_text.main_text(PAGE) == TEXT
    # Cut off anywhere, a page still gives text without markup.
    for stop in range(0, len(PAGE), 7):
        assert not re.search(r"[<>]|class=|href", html_text.main_text(PAGE[:stop]))


def test_skipped_elements_end_with_their_parent():
    rest = "<p>Rest of the article, which goes on for a while.</p>"
    want = "Before it and after.\nRest of the article, which goes on for a while."
    page = lambda x, close="</p>": f"<article><p>Before it {x} and after.{close}{rest}</article>"
    for x in (
        '<svg class="i"/>',
        "<math/>",
        "<svg><title/><path d='M0'/></svg>",
        "<svg><svg><text>no</text></svg><text>no</text></svg>",
        "<svg><foreignObject><div><p>no</p></div></foreignObject></svg>",
        "<button><div>no</div></button>",
        "<video src=v><p>no</p></video>",
        "<object>no<object>no</object><p>no</p></object>",
        "<svg><svg/><text>no</text></svg>",
        "<a href=x><svg><path></a>",
        "<select><option>no<option>no</select>",
        "<template><p>no</template>",
        "<canvas/>",
        "<script>'<button>'</script>",
    ):
        assert html_text.main_text(page(x)) == want, x
    # What is not closed takes the rest of its parent only.
    for x in "svg math button select object audio video canvas template".split():
        for close in ("</p>", ""):
            got = html_text.main_text(page(f"Short words here.<{x} id=a>no", close))
            assert got == want.replace("it and after.", "it Short words here."), (x, close)
        unclosed = f"<article><{x} id=a>no<p>Text that begins in it, and goes on.</p>{rest}</article>"
        assert html_text.main_text(unclosed).startswith("Text that begins in it"), x
    assert html_text.main_text(page("<script>", "")) == "Before it"


def test_a_frame_word_alone_makes_no_frame():
    text = "The article itself has a sentence that is long enough to be read."
    other = "A reader wrote this sentence, which is as long as any in the article."
    plain = f"<article><p>{text}</p></article>"
    for name in (
        "comments-wrapper",
        "comment-container",
        "commentsWrapper",
        "sidebar-wrap",
        "ad-container",
        "cookie-site-notice",
        "newsletter page",
    ):
        beside = f"<div class='{name}'><p>{other}</p><article class=comment><p>{other}</p></article></div>"
        for page in (
            f"<article><p>{text}</p>{beside}</article>",
            f"<div class=page>{beside}{plain}</div>",
            f"{plain}<div id='{name}'><div class=text><article><p>{other}</p></article></div></div>",
            f"<div class=post><p>{text}</p></div>{beside}",
        ):
            assert html_text.main_text(page) == text, (name, page)
        # The same name on what holds the article says nothing.
        for held in (plain, f"<main><p>{text}</p></main>", f"<div><section>{plain}</section></div>"):
            assert html_text.main_text(f"<div class='{name} layout'>{held}</div>") == text, name
    for name in ("has-sidebar", "page-with-sidebar", "no-sidebar", "post has-image comments-open"):
        assert html_text.main_text(f"<div class='{name}'><p>{text}</p></div>") == text, name


LONG = "A paragraph of the article, with as many words as readers are used to."


def test_a_form_around_the_page_is_no_form():
    rest = f"<nav><a href=x>Menu</a></nav><div><h1>Title of it</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div>"
    want = f"Title of it\n{LONG}\nShort one.\n{LONG}"
    for page in (
        f"<body><form action=a>{rest}<footer>Foot</footer></form></body>",
        f"<form><div class=page><form>{rest}</form></div></form>",
        f"<form class=form>{rest.replace('div', 'article')}</form>",
        f"<form><fieldset>{rest}</fieldset></form><p class=legal>Imprint</p>",
    ):
        assert html_text.main_text(page) == want, page
    small = f"<article><p>{LONG}</p><form><p>Leave your address and we will write to you.</p></form><p>{LONG}</p></article>"
    assert html_text.main_text(small) == f"{LONG}\n{LONG}"


def test_words_of_names_do_not_take_parts_of_an_article():
    for part in (
        "<div class='legal'>{}</div>",
        "<p class='market share'>{}</p>",
        "<div class='social-history'><p>{}</p></div>",
        "<details class='disclaimer'><summary>More on it</summary>{}</details>",
        "<address>{}</address>",
        "<noscript><p>{}</p></noscript>",
        "<section id=discussion><h2>Discussion</h2><p>{}</p></section>",
    ):
        inner = part.format(LONG)
        page = f"<header><a href=x>Home</a></header><article><h1>Title</h1><p>{LONG}</p>{inner}<p>{LONG}</p></article>"
        assert html_text.main_text(page).count(LONG) == 3, part
    # Beside the article the same names say what they mean.
    for name in ("legal", "notice", "share", "alert"):
        page = f"<div class={name}><p>{LONG}</p></div><article><p>Text. {LONG}</p></article>"
        assert html_text.main_text(page) == f"Text. {LONG}", name


def labels(page: str) -> tuple[list[bool], list[bool]]:
    """Labels by the score alone, and by the cut."""
    found, elements = html_text.blocks(page)
    scores = [block.score(html_text.WEIGHTS) for block in found]
    return [x > 0 for x in scores], html_text.minimum_cut(scores, list(html_text._edges(found, elements)))


def test_the_cut_changes_labels_for_the_better():
    page = f"<div><p>{LONG}</p><div>Figure one</div><p>{LONG}</p></div><ul><li>a<li>b</ul>"
    alone, cut = labels(page)
    assert alone == [True, False, True, False, False] and cut == [True, True, True, False, False]
    # Words among links of a list without a name.
    words = "Words enough to be taken for a line of text here"
    page = f"<ul><li><a href=x>a</a><li>{words}<li><a href=x>b</a></ul><p>{LONG}</p>"
    alone, cut = labels(page)
    assert alone == [False, True, False, True] and cut == [False, False, False, True]


def without_article(page: str) -> str:
    return html_text.ARTICLE_TAG.sub(r"\1div", page)


def article_blocks(page: str) -> list[str]:
    return html_text.main_text(page).split("\n")


def test_weights_learned_from_labelled_pages(spark, monkeypatch):
    pages = read(spark, SF, "pages")
    held_out = F.pmod(F.col("page_id"), F.lit(3)) == 0
    weights = html_text.learn(pages.filter(~held_out), "page_id")
    found = wanted = right = 0
    for row in pages.filter(held_out).collect():
        got = Counter(html_text.main_text(without_article(row.html), weights).split("\n"))
        want = Counter(article_blocks(row.html))
        found, wanted, right = found + got.total(), wanted + want.total(), right + (got & want).total()
    assert right / found > 0.99 and right / wanted > 0.99, (right, found, wanted)
    # Signs that no page has keep their weights, and so do all without labelled pages.
    assert weights["pre"] == html_text.WEIGHTS["pre"] and weights["p"] != html_text.WEIGHTS["p"]
    for none in (pages.filter("false"), pages.withColumn("html", F.lit("<p>no article</p>"))):
        assert html_text.learn(none, "page_id") == html_text.WEIGHTS
    monkeypatch.setattr(html_text, "PAGES", 20)
    hot = pages.withColumn("page_id", F.when(F.col("page_id") % 2 == 0, 1).otherwise(F.col("page_id")))
    assert html_text.learn(hot, "page_id").keys() == html_text.WEIGHTS.keys()


def test_deep_and_wide_pages_take_time_in_proportion():
    def seconds(page: str) -> float:
        start = time.process_time()
        html_text.main_text(page)
        return time.process_time() - start

    for part in ("<div>x", "<form><p>x", "<svg><desc>", "<button><b>", "</p><li>x", "<article class=ad>y"):
        assert seconds(part * 20_000) < 5, part
    text = html_text.main_text("<div>Some words that are a sentence." * 20_000)
    assert text.count("\n") == 19_999


def test_odd_pages():
    assert html_text.main_text("") == ""
    assert html_text.main_text("<nav><a href=x>Menu</a></nav>") == ""
    assert html_text.main_text("<p a='" * 10_000) == ""
    deep = "<div>" * 3_000 + "<p>Text that is long enough to be taken for content of a page.</p>"
    assert html_text.main_text(deep).startswith("Text that is long")
    many = "<article>" + "<p>Some words here, enough of them.</p><div class=ad>x y</div>" * 2_000
    assert html_text.main_text(many).count("\n") == 1_999


def test_minimum_cut_against_all_labellings():
    rng = random.Random(6)
    for _ in range(150):
        n = rng.randrange(1, 8)
        scores = [rng.choice([-3.0, -1.5, -0.5, 0.5, 1.0, 2.5]) for _ in range(n)]
        pairs = list(itertools.combinations(range(n), 2))
        edges = [(a, b, rng.choice([0.25, 0.5, 1.0])) for a, b in pairs if rng.random() < 0.5]

        def cost(labels):
            apart = sum(c for a, b, c in edges if labels[a] != labels[b])
            own = [s if s > 0 and not x else -s if s < 0 and x else 0 for s, x in zip(scores, labels)]
            return apart + sum(own)

        best = min(cost(labels) for labels in itertools.product([False, True], repeat=n))
        assert abs(cost(html_text.minimum_cut(scores, edges)) - best) < 1e-9


def test_query_against_the_article_element(spark):
    pages = {r.page_id: r for r in read(spark, SF, "pages").collect()}
    rows = op4_html_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id].html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        want = "\n".join(x for x in parts if x)
        assert (row.url, row.text, row.n_chars) == (pages[row.page_id].url, want, len(want))


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, PAGE, "c"), (3, PAGE, "c"), (None, "<p>\x00", None)]
    pages = spark.createDataFrame(rows, "page_id int, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [
        (0, got[-1].n_chars),
        (1, 0),
        (2, 0),
        (3, len(TEXT)),
        (3, len(TEXT)),
    ]
    assert html_text.extract(pages.filter("false")).count() == 0
