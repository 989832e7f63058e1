"""Main text: reading of markup, suffix arrays against brute force, whole pages."""

import random
from collections import defaultdict

from cartulary.llm import extract
from tests.llm.test_documents import same_as_sql


def test_equals_sql(spark, folder):
    same_as_sql(spark, folder, "op13_main_text")


def texts(html):
    return [b.text for b in extract.blocks_of(html) if b.state in (extract.NEUTRAL, extract.MAIN)]


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T &lt; </title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li>A<li>B</ul></nav><!-- <p>no</p> --><div id="cookieNotice">We use</div>
    <main><article class="post"><header><h1>Title&nbsp;&amp;
    more</h1></header><p>One <b>two</b>thr<i>ee</i><br>four<p title="a > b">five <a href="x">six</a>
    <form><label>Mail</label><input></form><div class="share-buttons">Tweet</div><aside>Side</aside><table><tr><td>x<td>y<tr><td>z</table>
    <noscript>no</noscript><ul><li>l1<li>l2</ul><section id=comments><article class="comment"><p>Nice</p></article></section></article></main>
    <footer>Foot &copy;</footer><p style="overflow:hidden">5 < 6 &am</p></body></html>"""
    assert texts(page) == ["Title & more", "One twothree four", "five six", "x y", "z", "l1", "l2", "5 < 6 &am"]


def test_broken_markup():
    assert texts("<p>a<p>b<script>x") == ["a", "b"]
    assert texts("a<b") == ["a"]
    assert texts("<div>one<!-->two<!--- ->three--> four</div") == ["onetwo four"]
    assert texts("<p><b>first<br><p>next</b></p></p></div>last") == ["first", "next", "last"]
    assert texts('<nav>menu<p title="x>') == []
    assert texts("<article><p>cut &quo") == ["cut &quo"]
    assert texts(None) == texts("") == texts(" <p> &nbsp;</p>") == []
    assert texts("<form id=aspnet><div>menu</div><article>text</article></form>") == ["text"]
    assert texts("</nav><" + "<b>" * 3000 + "x" + "</i>" * 3000 + "<p>y") == ["<x", "y"]


def plain_repeats(streams, span):
    """Of streams (page set, tokens): the windows on two pages or more, by stream."""
    pages = defaultdict(set)
    for own, tokens in streams:
        windows = {tuple(tokens[i : i + span]) for i in range(len(tokens) - span + 1)} if len(tokens) >= span else {tuple(tokens)}
        for w in windows:
            pages[w] |= own
    out = []
    for _, tokens in streams:
        starts = range(len(tokens) - span + 1) if len(tokens) >= span else [0]
        out.append([i for i in starts if len(pages[tuple(tokens[i : i + span])]) > 1])
    return out


def test_repeats_equal_brute_force(spark):
    """One array, and many blocks of one host; hosts don't mix; a run twice on one page is no repeat."""
    rng = random.Random(1)
    rows, streams = [], defaultdict(lambda: defaultdict(set))
    for page in range(60):
        host = "a.example" if page % 3 else "b.example"
        for _ in range(3):
            text = " ".join(rng.choices("abc", k=rng.choice([1, 2, 3, 6, 9])))
            rows.append((host, str(page).encode(), extract.digest(text), text, len(text.split())))
            streams[host][text].add(page)
        rows.append((host, str(page).encode(), None, None, 0))
    text = "twice on this page twice on this page"
    rows.append(("b.example", b"0", extract.digest(text), text, 8))
    streams["b.example"][text].add(0)
    df = spark.createDataFrame(rows, "host string, page binary, region binary, text string, tokens long")
    expected = {}
    for host, texts in streams.items():
        for text, starts in zip(texts, plain_repeats([(own, t.split()) for t, own in texts.items()], 4)):
            if starts:
                expected[host, bytes(extract.digest(text))] = starts
    for block in (1 << 20, 20):
        got = extract.repeats(df, span=4, block=block).collect()
        assert {(r.host, bytes(r.region)): sorted(r.starts) for r in got} == expected


SOUP = "<div>Home News Sport Weather Culture Travel Money Shop{}</div><div class=x{}>{}</div><div>Share</div><div>All rights reserved by the example company of all examples since 1999</div>"


def soup(n):
    return SOUP.format(" Today" * (n % 2), n, " ".join(f"w{n}x{i}" for i in range(40)))


def test_pages_without_marks(spark):
    """Menus and footers without any telling markup go as repeats of their host; unique text and copies of articles stay."""
    copy = " ".join(f"c{i}" for i in range(60))
    pages = [(n, f"http://h.example/{n}", soup(n)) for n in range(40)]
    pages += [(100 + n, f"http://h.example/c{n}", f"<p>{copy}</p><div>Home News Sport Weather Culture Travel Money Shop {n}</div>") for n in range(2)]
    pages += [(200, "http://other.example/", soup(1)), (201, None, soup(2)), (202, "no host", soup(2))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for block in (1 << 20, 64):
        rows = {r.page_id: r for r in extract.main_text(df, block=block).collect()}
        for n in range(40):
            assert rows[n].text == " ".join(f"w{n}x{i}" for i in range(40)) and rows[n].n_repeated == 3
        assert rows[100].text == rows[101].text == copy
        assert rows[200].text.startswith("Home") and rows[201].text == rows[202].text and rows[202].n_repeated == 0


def test_edges(spark):
    """Nulls, empty and very long pages, repeated rows, clashing columns, an empty table."""
    long = "<article>" + "<p>word and more</p>" * 30_000 + "</article>"
    rows = [(1, "http://a/", None), (2, None, ""), (3, None, None), (4, "http://a/", long), (5, "http://a/", "<p>x</p>"), (5, "http://a/", "<p>x</p>"), (None, "http://a/", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "'h' as host", "'p' as page", "1 as blocks", "2 as whole", "3 as found")
    out = extract.main_text(df)
    assert out.columns == ["page_id", "url", "host", "page", "blocks", "whole", "found", "text", "n_repeated", "n_marked"]
    got = out.collect()
    assert len(got) == 7 and all((r.host, r.page, r.blocks, r.whole, r.found) == ("h", "p", 1, 2, 3) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == "" and by_id[4] == "\n".join(["word and more"] * 30_000)
    assert by_id[5] == by_id[None] == "x"
    assert extract.main_text(df.limit(0)).count() == 0
