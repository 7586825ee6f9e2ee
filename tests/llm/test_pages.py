"""Main text of pages by inferred wrappers (op3)."""

import html
import random
import re

import pytest

from starling.llm import registry, wrappers

from llm_helpers import SF01, clashing, con, documents, empty, odd  # noqa: F401


def show(items):
    return " ".join((f"({show(x.body)})+" if x.label == "(" else x.label) + ("?" if x.optional else "") for x in items)


def text_of(pages):
    """Main texts of the pages of one host, without Spark."""
    found = {}
    for p in pages:
        wrappers.sum_up(found, "host", p)
    known = wrappers.infer(list(found.values()))
    out = []
    for p in pages:
        items, texts, _, name = wrappers.read_page(p)
        main, template = known[name]
        equal = {(k, h) for k, own in enumerate(template) for h in own}
        out.append(wrappers.blocks_text(texts, wrappers.main_texts(items, texts, main, equal)))
    return out


def test_whole_table(spark, con):
    rows = con.execute("SELECT page_id, url, html FROM pages").fetchall()
    got = {r["page_id"]: r for r in registry.op3_page_text(spark, SF01).collect()}
    assert len(got) == len(rows)
    for i, url, page in rows:
        article = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(x for x in parts if x)
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want) and got[i]["url"] == url


def test_repeats_become_groups():
    items, _ = wrappers.shape_of("<ul><li>a</li><li>b</li><li>c</li></ul><p>x</p>")
    assert show(items) == "<ul> (<li> # </li>)+ </ul> <p> # </p>"
    items, texts = wrappers.shape_of("<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td><td>5</td></tr></table>")
    assert show(items) == "<table> (<tr> (<td> # </td>)+ </tr>)+ </table>"
    assert sorted(t for s in wrappers.slots(items) for t in s.texts) == list(range(len(texts)))


def test_alignment_makes_options_and_repetitions():
    w = wrappers.Wrapper()
    for page in ("<body><h1>t</h1><p>a</p></body>", "<body><h1>t</h1><p>a</p><p>b</p></body>",
                 "<body><h1>t</h1><em>by</em><p>a</p><p>b</p></body>"):
        shape, _ = wrappers.shape_of(page)
        n = len(list(wrappers.slots(shape)))
        w.add(shape, wrappers.Shape("", "", 1, [1.0] * n, [0.0] * n, [{}] * n, []))
    assert show(w.items) == "<body> <h1> # </h1> <em>? #? </em>? (<p> # </p>)+ </body>"


PAGES = [f"""<html><head><title>T{k}</title><style>p{{}}</style><script>if (a < b) document.write("<p>no</p>");</script></head><body>
<header><h2>Site</h2></header><div class="cookie-notice">We use cookies</div><nav><ul><li><a href=/>Home</a></li><li><a href=/x>X</a></li></ul></nav>
<div class="layout"><div class="main-col"><h1>Title {k} &amp; more</h1>{"".join(f"<p>Para {j} of  page {k}, <b>bold</b> and<br>broken &lt;here&gt; &eacute;.</p>" for j in range(k + 1))}
<form><label>Mail</label><input name=m><button>Go</button></form></div><div id="sidebar"><p>Related stuff</p></div></div>
<div class="comments"><p>First!</p><p>Nice page {k}</p></div><footer>(c) {k}</footer></body></html>""" for k in range(4)]


def test_page_without_article_element():
    for k, got in enumerate(text_of(PAGES)):
        want = [f"Title {k} & more"] + [f"Para {j} of page {k}, bold and broken <here> é." for j in range(k + 1)]
        assert got.split("\n") == want


def test_odd_pages():
    odd = ["", "plain text only", "<p>cut off in the mid", "<p>a</p", "<<<>>>", "<p>a<p>b<p>c", "&amp &lt;b&gt; &#233; &#x1F600; &bogus;",
           "<script>never closed", "<!-- open", "<p title='a>b'>x</p>", "<P CLASS=Ad>ad</P><P>text</P>", "a\x00b", "<ul><li>one<li>two</ul>"]
    for page in odd:
        assert isinstance(text_of([page])[0], str)
    assert text_of(["plain text  only"]) == ["plain text only"]
    assert text_of(["<p>a<p>b<p>c"]) == ["a\nb\nc"]
    assert text_of(["&amp &lt;b&gt; &#233;"]) == ["& <b> é"]
    assert text_of(["<P CLASS=Ad>ad</P><P>text</P>"]) == ["text"]
    assert text_of(["<article><p>kept</p></article><p>not</p>"]) == ["kept"]
    assert text_of(["<div class='page with-sidebar'><h1>T</h1><p>kept</p><div class=sidebar><p>not</p></div></div>"]) == ["T\nkept"]


def test_random_pages_lose_no_slot():
    rng = random.Random(8)
    for _ in range(200):
        page = "".join(rng.choice(["<p>", "</p>", "<li>", "</li>", "<div>", "</div>", "x ", "y", "<b>", "</b>", "<br>"]) for _ in range(40))
        items, texts = wrappers.shape_of(page)
        assert sorted(t for s in wrappers.slots(items) for t in s.texts) == list(range(len(texts)))


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(k, "https://Host.example/a", p) for k, p in enumerate(PAGES)] + [
        (10, None, "<p>no url</p>"), (11, "not a url", None), (12, "https://one.example:80/x", ""), (12, "https://one.example:80/x", ""),
        (None, "https://one.example/y", "<article>" + "<p>long text goes here</p>" * 20000 + "</article>")]
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id bigint, url string, html string, text string, shape int")


def test_odd_rows(odd_pages, monkeypatch):
    got = {r["page_id"]: r["text"] for r in wrappers.pages_digest(odd_pages).collect()}
    assert got[0] == "Title 0 & more\nPara 0 of page 0, bold and broken <here> é."
    assert got[10] == "no url" and got[11] == "" and got[12] == ""
    assert got[None].count("\n") == 19999
    assert wrappers.pages_digest(odd_pages).count() == odd_pages.count()
    assert wrappers.pages_digest(odd_pages.limit(0)).count() == 0
    monkeypatch.setattr(wrappers, "MOST_SHAPES", 2)
    monkeypatch.setattr(wrappers, "BROADCAST_SHAPES", 0)  # the other way to attach main slots
    assert {r["page_id"]: r["text"] for r in wrappers.pages_digest(odd_pages).collect()} == got
