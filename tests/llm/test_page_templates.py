"""Main text (op3) of hosts with several templates, and of pages without a host."""

import random
import time

from starling.llm import wrappers

from test_pages import PAGES, text_of

ARTICLES = [f"<body><h1>Head {k}</h1><article><p>{'Long article text. ' * 20}{k}</p></article><div>Around {k}</div></body>" for k in range(6)]
POST = ("<body><div class=post><h2>Listing</h2><ul><li>one</li><li>two</li></ul><p>A paragraph below the list.</p></div>"
        "<div class=sidebar><p>not</p></div></body>")
POST_TEXT = "Listing\none\ntwo\nA paragraph below the list."


def test_template_beside_articles():
    """Pages without an article keep their lists and paragraphs on a host of articles."""
    got = text_of([*ARTICLES, POST])
    assert got[-1] == POST_TEXT
    assert got[0] == ("Long article text. " * 20 + "0")


def test_template_with_less_text():
    """The smaller template is not cut by the container of the larger one."""
    large = [f"<body><div class=story><p>{'Much more text is here. ' * 40}{k}</p><p>end</p></div></body>" for k in range(6)]
    got = text_of([*large, POST])
    assert got[-1] == POST_TEXT and got[0].endswith("0\nend")


def test_short_page_is_cut_like_its_siblings():
    """The host's pages tell the container where one page has little text in it."""
    def page(n):
        return f"<body><div class=story><p>{'words ' * n}</p></div><div class=box><p>{'box ' * 30}</p></div></body>"
    got = text_of([page(400), "<body><div class=story><p>" + "more " * 300 + "</p><em>x</em></div><div class=box><p>box</p></div></body>", page(1)])
    assert [("box" in x) for x in got] == [False, False, False]
    got = text_of([page(400), "<body><div class=story><em>x</em><p>few</p></div><div class=box><p>" + "box " * 30 + "</p></div></body>"])
    assert "few" in got[1]


def test_text_always_has_a_main_slot():
    links = "<body><ul>" + "".join(f"<li><a href=/{k}>Entry {k}</a></li>" for k in range(4)) + "</ul></body>"
    assert text_of([*ARTICLES, links])[-1] == "\n".join(f"Entry {k}" for k in range(4))


def test_pages_without_host_do_not_meet(spark):
    """Null and relative urls: each page has the text it has alone."""
    pages = [*ARTICLES, POST, *PAGES]
    rows = [(k, None if k % 2 else f"/page/{k}", p) for k, p in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in wrappers.pages_digest(
        spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[6] == POST_TEXT
    # Pages of one shape share its wrapper.
    assert got == {k: text_of([p])[0] for k, p in enumerate(pages)}


WORDS = [f"word{k}" for k in range(400)]


def bare(k, extra=""):
    """A page without an article element or a telling class: the motto, the hint and the last lines are the site's."""
    rng = random.Random(k)
    story = [" ".join(rng.choices(WORDS, k=40)) for _ in range(2 + k % 3)]
    inner = "".join(f"<div>{p}</div>" for p in story)
    page = (f"<body><div>Daily pages for <b>everyone</b></div><div><h2>Story number {k}</h2>{inner}<div>Press the bell to hear from us</div></div>{extra}"
            "<div>Made in the north</div><div>All rights kept</div></body>")
    return page, "\n".join([f"Story number {k}", *story])


def test_wrapper_tells_template_from_content():
    """The furniture of a host goes because it is equal on its pages; no tag or class names it."""
    made = [bare(k) for k in range(12)]
    assert text_of([p for p, _ in made]) == [t for _, t in made]
    # Judged alone, each page keeps all of it.
    for page, text in made:
        alone = text_of([page])[0]
        assert alone != text and "Press the bell to hear from us" in alone


def test_template_needs_different_pages():
    """Fewer pages than the bound, copies of one page and near copies show no template."""
    few = [bare(k)[0] for k in range(wrappers.TEMPLATE_PAGES - 1)]
    assert all("Press the bell" in x for x in text_of(few))
    page, text = bare(1)
    for pages in ([page] * 20, [page.replace("Story number 1", f"Story number {k}") for k in range(20)]):
        assert all(set(text.split("\n")[1:]) <= set(x.split("\n")) for x in text_of(pages))


def test_template_by_spark(spark, monkeypatch):
    """By many tasks, as by one; with the table of blocks broadcast and joined."""
    made = [bare(k) for k in range(12)]
    rows = [(k, "https://bare.example/" + str(k), p) for k, (p, _) in enumerate(made)] + [(100 + k, None, p) for k, (p, _) in enumerate(made)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(7, "page_id")
    want = {k: t for k, (_, t) in enumerate(made)} | {100 + k: text_of([p])[0] for k, (p, _) in enumerate(made)}
    assert {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()} == want
    monkeypatch.setattr(wrappers, "BROADCAST_BLOCKS", 0)
    assert {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()} == want


def test_equal_text_in_an_article_stays():
    pages = [f"<body><div>Site</div><article><p>Opening words of the series.</p><p>{bare(k)[1]}</p></article></body>" for k in range(12)]
    assert all(x.startswith("Opening words of the series.") for x in text_of(pages))


def test_elements_never_closed():
    """Time and memory grow with the page, not with its square, and furniture at any depth goes."""
    took = []
    for n in (5_000, 20_000):
        page = "<p>first</p>" + "<font size=2><b>" * n + "<nav>menu<i>more</i></nav>text"
        start = time.process_time()
        got = text_of([page])[0]
        took.append(time.process_time() - start)
        assert "first" in got and "text" in got and "menu" not in got and "more" not in got
    assert took[1] < 10 * took[0] + 1
