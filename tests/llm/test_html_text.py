import json
import random
import re
import time
import tracemalloc
from html import unescape

from riskloom.llm import html_text
from riskloom.llm.html_text import Page, align, main_texts, wrappers
from tests.llm.helpers import SF


def text(html):
    return Page(html).main_text(set())


def test_whole_table_equals_a_reading_of_its_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    expected = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        parts = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        expected[r.page_id] = "\n".join(p for p in (" ".join(unescape(x).split()) for x in parts) if p)
    got = main_texts(pages).collect()
    assert {r.page_id: r.text for r in got} == expected
    assert all(r.n_chars == len(r.text) for r in got)


def test_marks_and_mended_markup():
    page = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body class="has-sidebar">
    <header class=site><h2>Site</h2></header><div id="cookie-notice">We use</div><div class="page with-menu"><main>
    <header><h1>T &amp;amp; &#233;&nbsp;&lt;</h1></header><p>One<p>Two <b>bo</b>ld<br>line<script>var t="</p>";</script>
    <aside>x</aside><ul><li>a<li>b</ul><form>q <input></form><!-- c --><div class="ad">buy</div>
    <table><tr><td>c1<td>c2</table><section id="comments"><article class="comment">no</article></section></main></div>
    <div class="sidebar">s</div><footer>f</footer>"""
    assert text(page) == "T &amp; é <\nOne\nTwo bold line\na\nb\nc1\nc2"


def test_no_marked_article():
    page = '<nav>n</nav><div><a href="/">Home</a> <a href="/b">More</a></div><div><p>Hello <a>you</a></p>tail</div><p hidden>h</p>'
    assert text(page) == "Hello you\ntail"
    assert text("") == text("<div></div>") == "" and text("just text &amp more <b") == "just text & more"
    assert text("<div>" * 20_000 + "deep") == "deep"


def test_trees_are_aligned_by_order_preserving_matching():
    a, b = Page("<div><h1>a</h1><p>x</p><ul><li>1</ul></div>"), Page("<div><p>x</p><p>y</p><h2>n</h2><ul><li>1<li>2</ul></div>")
    places = align(a.tree(), b.tree())
    label = lambda page, k: page.nodes[k][1]
    matched = [(label(a, i), label(b, p)) for i, p in enumerate(places) if p >= 0]
    assert matched == [("#", "#"), ("div.", "div."), ("p.", "p."), ("ul.", "ul."), ("li.", "li.")]


def test_constant_nodes_of_a_host_are_template(spark, frame):
    page = "<div class=top>Welcome to us</div><div class=main><p>Story {0} of the day</p><p>More {0}</p></div><div class=end>All rights</div>"
    rows = [(i, "http://h.example/" + str(i), page.format(i)) for i in range(8)]
    rows += [(100, "https://h.example:8080/x?y", page.format("late") + "<ul><li>only here</ul>")]
    rows += [(200 + i, "http://copies.example/", page.format("same")) for i in range(8)]
    rows += [(300, None, page.format("a")), (301, "no host", page.format("b")), (302, "http://one.example", None), (None, "http://H.example/9", "")]
    pages = frame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS tree", "'y' AS text")
    got = {r.page_id: r.text for r in main_texts(pages).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"Story {i} of the day\nMore {i}" for i in range(8))
    assert got[100] == "Story late of the day\nMore late\nonly here"
    everything = "Welcome to us\nStory {0} of the day\nMore {0}\nAll rights"
    assert got[200] == everything.format("same") and got[300] == everything.format("a") and got[301] == everything.format("b")
    assert got[302] == got[None] == ""
    assert {r.host: len(r.template or []) for r in wrappers(pages).collect()}["h.example"] == 2
    assert main_texts(pages.where("false")).count() == 0


def test_wrapper_decides_inside_and_beside_marked_articles(frame):
    page = "<div class=lead>Lead {0}</div><div class=box>Site box</div><article><div class=by>By our desk</div><p>Story {0}</p></article>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(8)]
    copy = "<i>{0}</i>" + page.format("same")  # differs only beside the article
    rows += [(100 + i, f"http://copies.example/{i}", copy.format(i)) for i in range(8)]
    rows += [(200, "http://few.example/", page.format("few"))]
    got = {r.page_id: r.text for r in main_texts(frame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Lead {i}\nStory {i}" for i in range(8))
    assert all(got[100 + i] == "By our desk\nStory same" for i in range(8))
    assert got[200] == "By our desk\nStory few"


def plain_alignment(first, second):
    """Simple tree matching with a whole table for every pair of nodes."""
    below = [[[k for k, (p, _) in enumerate(nodes) if p == number] for number in range(len(nodes))] for nodes in (first, second)]

    def table(a, b):
        left, right = below[0][a], below[1][b]
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                own = 1 + table(x, y)[-1][-1] if first[x][1] == second[y][1] else 0
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + own)
        return best

    found, work = [-1] * len(first), [(0, 0)]
    while work:
        a, b = work.pop()
        found[a] = b
        best, left, right = table(a, b), below[0][a], below[1][b]
        i, j = len(left), len(right)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                work.append((left[i], right[j]))
    return found


def test_alignment_equals_a_plain_one_with_either_kind_of_table(monkeypatch):
    draw = random.Random(8)

    def tree():
        nodes = [(-1, "html")]
        for _ in range(draw.randrange(1, 14)):
            nodes.append((draw.randrange(max(0, len(nodes) - 4), len(nodes)), draw.choice("abc")))
        return nodes

    for small in (0, 4096):
        monkeypatch.setattr(html_text, "SMALL_TABLE", small)
        for _ in range(150):
            a, b = tree(), tree()
            assert align(json.dumps(a), json.dumps(b)) == plain_alignment(a, b)


def test_twenty_thousand_siblings_align_in_bounded_memory():
    a = [(-1, "body"), *((0, "h2" if k % 2 else "p") for k in range(20_000))]
    b = [(-1, "body"), *((0, "h2" if k % 2 else "p") for k in range(10_000)), (0, "ul"), *((0, "h2" if k % 2 else "p") for k in range(10_000))]
    tracemalloc.start()
    started = time.process_time()
    found = align(json.dumps(a), json.dumps(b))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 500e6 and time.process_time() - started < 120
    assert sum(k >= 0 for k in found) == 20_001 and 10_001 not in found
