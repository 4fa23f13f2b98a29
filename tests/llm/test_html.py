import html as entities
import re

import pytest

from llm.helpers import SMOKE, empty
from payguard.llm import html
from payguard.llm.queries import op2_html_text


def test_given_pages_match_a_plain_reading(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMOKE}/pages.parquet").collect()}
    got = op2_html_text(spark, SMOKE).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        parts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*(>|\Z)", "", p.replace("<br>", " ")))).strip() for p in re.split(r"</?(?:h1|p)>", article)]
        want = "\n".join(p for p in parts if p)
        assert r["text"] == want and r["n_chars"] == len(want)


PAGE = """<html><head><title>t</title></head><body><header><h1>Site</h1><a href=x>Home</a></header>
<div class="sidebar"><p>Side text, long enough. Really.</p></div><div class="cookie-notice">We use cookies.</div>
<main><article><h1>Title &amp; more</h1><p>One  two<br>three <i>four</i>.</p><ul><li>item a<li>item b</ul>
<div class="ad-box">Buy</div><script>var x = "</p>";</script><table><tr><td>c1<td>c2</table><form><input>Sub</form></article>
<section id="comments"><p>Nice post, thanks a lot.</p></section></main><footer>foot</footer></body></html>"""


def test_furniture_goes():
    assert html.main_text(PAGE) == "Title & more\nOne two three four.\nitem a\nitem b\nc1\nc2"


def test_pages_without_article_element():
    page = ("<body><div id=menu><a>x</a><a>y</a></div><div id=c><p>Hello there, you who read.</p><p>More text, and more.</p></div>"
            "<div class=footer>f</div></body>")
    assert html.main_text(page) == "Hello there, you who read.\nMore text, and more."
    assert html.main_text("plain text only") == "plain text only"


LONG = "A sentence of the article, and it is long enough. "


def test_class_words_of_frames_and_wrappers_mark_nothing():
    body = f"<h1>Title</h1><p>{LONG * 5}</p><p>{LONG * 3}</p>"
    want = f"Title\n{(LONG * 5).strip()}\n{(LONG * 3).strip()}"
    side = "<div class=sidebar><p>Side text, long enough. Really.</p></div>"
    for page in (f"<body class='single-post right-sidebar'><div>{body}</div>{side}</body>", f"<body><main class='has-sidebar'>{body}</main>{side}</body>",
                 f"<body><div id=wrapper class='no-sidebar'>{body}{side}</div></body>", f"<html class=menu-closed><body class='home header-fixed'>{body}{side}",
                 f"<article class='post comments-open'>{body}</article>{side}", f"<form id=aspnetForm>{body}</form>{side}"):
        assert html.main_text(page) == want, page
    thread = "<div class=comments>" + f"<p>{LONG * 5}</p>" * 3 + "</div>"
    assert html.main_text(f"<body><div>{body}</div>{thread}</body>") == want


def test_paths_above_the_threshold_stay():
    para = f"<p>{LONG * 4}</p>"
    refs = "<ul>" + "".join(f"<li><a href=r{i}>Reference {i}</a></li>" for i in range(8)) + "</ul>"
    items = "<ul>" + "<li>ab</li>" * 20 + "</ul>"
    line = (LONG * 4).strip()
    got = html.main_text(f"<article><h1>T</h1>{para}<h2><a href=x>Linked heading</a></h2>{para}<figure><img src=x><figcaption>The caption</figcaption>"
                         f"</figure>{para}{items}{para}{refs}</article>").split("\n")
    assert got == ["T", line, "Linked heading", line, "The caption", line, *["ab"] * 20, line, *[f"Reference {i}" for i in range(8)]]
    links = "<div><ul>" + "".join(f"<li><a href=m{i}>Menu {i}</a></li>" for i in range(8)) + "</ul></div>"
    got = html.main_text(f"<body>{links}<div><h1>T</h1><p>The lead.</p><div class=body>{para}{para}</div></div>{links}</body>")
    assert got == f"T\nThe lead.\n{line}\n{line}"


def test_broken_markup():
    assert html.main_text('<p>see <a href="foo>bar</a> baz</p><p>next &am') == "see bar baz\nnext &am"
    assert html.main_text("<p>a<p>b") == "a\nb"
    assert html.main_text("") == "" and html.main_text(None) == "" and html.main_text("<") == "<"
    assert html.main_text("<div>" * 5000 + "deep") == "deep"


def test_awkward_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE)], "page_id bigint, url string, html string")
    got = html.extract(pages).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, *[len(html.main_text(PAGE))] * 2]
    assert html.extract(empty(spark, pages)).count() == 0


BODY = "<p>The harbour was rebuilt in 1987, after the storm, and ships returned.</p><p>Then, years later, the town grew; people came, and stayed.</p>"
TEXT = "The harbour was rebuilt in 1987, after the storm, and ships returned.\nThen, years later, the town grew; people came, and stayed."


@pytest.mark.parametrize("page,want", [
    (f"<body><a name=top><h1>Title</h1>{BODY}</body>", f"Title\n{TEXT}"),
    (f"<body><article><a name=top>{BODY}</article></body>", TEXT),
    (f"<body><div>{BODY}<a name=end></div></body>", TEXT),
    (f"<body><article><a href='/x'>{BODY}</article></body>", TEXT),
    (f"<div><h1 class='page-header'>Big title</h1>{BODY}<p class='legal'>A legal, but real paragraph of it.</p></div>",
     f"Big title\n{TEXT}\nA legal, but real paragraph of it."),
    ("<p><a href=u>all of it</a></p>", "all of it"),
    ("<p>" + "<b>" * 300 + "one</p><p>two", "one\ntwo"),
])
def test_open_links_and_class_words(page, want):
    assert html.main_text(page) == want


def test_link_text_is_what_closed_links_hold():
    blocks = html.leaves("<div><a href=1>one</a> two <a href=3>three</a></div><a href=4>four <a href=5>five</a><p>six</p><a name=x>seven")
    assert [(text, links) for _, text, _, links in blocks] == [("one two three", 8), ("four five", 9), ("six", 0), ("seven", 0)]


def test_time_of_a_long_page_grows_with_its_length():
    import time
    took = []
    for n in (4000, 8000):
        start = time.time()
        html.main_text(("<div class=a><i><p>some text, and more<b>" + BODY) * n)
        took.append(time.time() - start)
    assert took[1] < 4 * took[0] + 1
