import math
import random
import time

import numpy as np

from jobfacts.llm import htmltext
from tests.llm.helpers import clashing

LONG = "A long sentence of the article that goes on and on, with many words &amp; few tags in it. " * 3
PLAIN = " ".join(LONG.replace("&amp;", "&").split())


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x = "</p><p>no</p>";</script></head><body>
    <header><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies {LONG}</div>
    <div class="ad">Buy {LONG}</div><article><header><h1>Title</h1></header><p>{LONG}<p>Short.</p>
    <aside>Related {LONG}</aside><p>With <b>bold</b>er&nbsp;text<br>and a \n new line</p><form><p>Your name</p></form>
    <section id="comments"><p>Reader: {LONG}</p></section><p hidden>{LONG}</p><ul><li>One<li>Two</ul></article>
    <div class="sidebar">{LONG}</div><footer>&copy; {LONG}</footer></body></html>"""
    assert htmltext.main_text(page) == "\n".join(["Title", PLAIN, "Short.", "With bolder text and a new line", "One", "Two"])


def test_page_without_named_regions():
    links = "".join(f'<div><a href="/{i}">link {i}</a></div>' for i in range(30))
    page = f"<body><div>{links}</div><div><div><p>{LONG}</p><p>Brief</p><p>{LONG}</p></div></div><div>{links}</div></body>"
    assert htmltext.main_text(page) == f"{PLAIN}\nBrief\n{PLAIN}"


def test_edges():
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<p></p>") == ""
    assert htmltext.main_text("just text &lt;b&gt; &#233; &eacute") == "just text <b> é é"
    assert htmltext.main_text("<p>one<p>two</div></p></span><p>three") == "one\ntwo\nthree"
    assert htmltext.main_text("<article><p>cut off in a ta") == "cut off in a ta"
    assert len(htmltext.main_text("<div>" * 3000 + "deep" + "<p>x" * 3000)) == 4 + 2 * 3000


def test_smoothing_and_threshold_against_plain_versions():
    values = np.array([1.0, 50, 2, 90, 80, 3])
    reach = int(3 * htmltext.SIGMA + 0.5)
    for i, got in enumerate(htmltext.smooth(values)):
        weights = {j: math.exp(-0.5 * ((i - j) / htmltext.SIGMA) ** 2) for j in range(6) if abs(i - j) <= reach}
        assert abs(got - sum(w * values[j] for j, w in weights.items()) / sum(weights.values())) < 1e-9
    cut = htmltext.threshold(values)
    low, high = values[values < cut].mean(), values[values >= cut].mean()
    assert abs(cut - (low + high) / 2) < 1e-9
    assert htmltext.threshold(np.array([4.0, 4.0])) == 4.0


def test_query(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (2, None, None), (None, "v", "<p>é \U0001F600</p>"), (1, "u", f"<article><p>{LONG}</p></article>")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted((repr(r.page_id), repr(r.url), r.text, r.n_chars) for r in htmltext.html_query(pages).collect())
    assert got == sorted([("1", "'u'", PLAIN, len(PLAIN)), ("1", "'u'", PLAIN, len(PLAIN)), ("2", "None", "", 0), ("None", "'v'", "é \U0001F600", 3)])
    assert htmltext.html_query(pages.limit(0)).collect() == []


def test_outer_headline_sibling_sections_and_two_articles():
    assert htmltext.main_text(f"<body><div id=c><h1>T</h1><div class=b><p>{LONG}</p><p>{LONG}</p></div></div></body>") == f"T\n{PLAIN}\n{PLAIN}"
    sections = f"<div><div><p>{LONG}</p><p>Brief</p></div><div><h2>Next</h2><p>{LONG}</p></div><div><p>{LONG}</p></div></div>"
    links = "".join(f'<div><a href="/{i}">link {i}</a></div>' for i in range(30))
    assert htmltext.main_text(f"<body><div>{links}</div>{sections}<div>{links}</div></body>") == f"{PLAIN}\nBrief\nNext\n{PLAIN}\n{PLAIN}"
    two = f"<body><div>{links}</div><div><article><h1>A</h1><p>{LONG}</article><article><h1>B</h1><p>{LONG}</article></div></body>"
    assert htmltext.main_text(two) == f"A\n{PLAIN}\nB\n{PLAIN}"
    split = f"<body><article><div><p>{LONG}</div><div><p>short end</div></article><p>outside</p></body>"
    assert htmltext.main_text(split) == f"{PLAIN}\nshort end"


def test_names_of_parts():
    body = f"<article><h1>T</h1><p>{LONG}</p></article>"
    for frame in ('class="post comments-open no-sidebar"', 'id="content" class="related-posts-off"', 'class="has-banner"', 'class="notice"', 'id="comments"'):
        assert htmltext.main_text(f"<body><div {frame}>{body}</div></body>") == f"T\n{PLAIN}", frame
    for part in ('class="comment-list"', 'class="x sidebar-left"', 'id="ad-300x250"', 'role="complementary"', 'class="related-posts"', 'class="share-buttons"'):
        assert htmltext.main_text(f"<body>{body}<div {part}><p>{LONG}</p></div></body>") == f"T\n{PLAIN}", part
        assert htmltext.main_text(f"<body><article><h1>T</h1><p>{LONG}</p><div {part}><p>{LONG}{LONG}{LONG}</p></div></article></body>") == f"T\n{PLAIN}", part


def test_nothing_but_parts_goes_from_random_articles():
    """Every block of an article stays, in order, whatever surrounds it: the expected text is
    the list that the page was made of."""
    rng = random.Random(11)
    for _ in range(300):
        own, html = [], []
        for k in range(rng.randrange(1, 12)):
            text = " ".join(rng.choice(["alpha", "beta", "&amp;", "délta", "x<b>y</b>z"]) for _ in range(rng.randrange(1, 60)))
            own.append(text.replace("&amp;", "&").replace("<b>", "").replace("</b>", ""))
            tag = rng.choice(["p", "h2", "li", "blockquote", "div"])
            html.append(f"<ul><li>{text}</ul>" if tag == "li" else f"<{tag}>{text}</{tag}>" if rng.random() < 0.8 or tag != "p" else f"<p>{text}")
            if rng.random() < 0.3:
                html.append(rng.choice([f"<aside>{LONG}</aside>", f"<div class=ad>{LONG}</div>", "<script>var a = '<p>no</p>'</script>", "<form>x</form>"]))
        around = f"<nav>{LONG}</nav>", f"<footer>{LONG}</footer>"
        page = f"<html><body>{around[0]}<div><article>{''.join(html)}</article></div>{around[1]}</body></html>"
        assert htmltext.main_text(page) == "\n".join(own)


def test_time_is_linear():
    for unit, most in (("<a ", 2), ("<!--", 2), ("<div>x", 20), ("<div>", 20), ("<p>x", 25), ("<a b='", 5), ("<table><td>x", 20), ("<div class=comments>x", 20)):
        at = time.perf_counter()
        htmltext.main_text(unit * (10 ** 6 // len(unit)))
        assert time.perf_counter() - at < most, unit
