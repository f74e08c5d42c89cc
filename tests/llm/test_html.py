"""HTML extraction: LCS against brute force, rules of blocks, partners, and all pages against a plain extraction."""

import html as entities
import random
import re

import pytest

from plumbmart.llm import html, queries


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("cells", [1 << 26, 20, 1])
def test_longest_common_subsequence(cells):
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, rng.choice([2, 9])) for _ in range(rng.randint(0, 25))] for _ in range(2))
        found = html.common(a, b, cells)
        assert found == sorted(set(found)) and len(found) == brute_lcs(a, b)
        it = iter(b)
        assert all(any(a[i] == y for y in it) for i in found)


def kept(page, article_only=False):
    return [t for kind, t in html.lines_of(page) if kind == html.KEEP or (kind == html.OPEN and not article_only)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain &amp; text\n\t more&nbsp;x", ["plain & text more x"]),
        ("<p>a<b>b</b>c<p>d<br>e</p>f", ["abc", "d e", "f"]),
        ("<title>t</title><script>var a='</p>';</script><style>p{}</style><p>x<!-- no --></p>", ["x"]),
        ("<nav><ul><li>m<li>n</ul></nav><div class='ad'>buy</div><p>x</p><footer>f</footer>", ["x"]),
        ("<div id=sidebar><div>in</div></div><div class='post'>x</div><form><p>f</form>", ["x"]),
        ("<form><article><header><h1>T</h1></header><p>x</p><section class=comments><p>c</p></section><aside>s</aside></article></form>", ["T", "x"]),
        ("<p class=notice>n<p>x<span class=ads>y</span>z</p><p hidden>h</p><p style='display: none'>h</p>", ["xz"]),
        ("<p>cut &am", ["cut &am"]),
        ("<p>a</p><p cla", ["a"]),
        ("<p>a < b > c</p>", ["a < b > c"]),
        ('<p title="a>b">x</p><p title="open>y</p>z', ["x", "y", "z"]),
        ("<script>never closed <p>x", []),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("</div></p>x</article>", ["x"]),
    ],
)
def test_blocks(page, want):
    assert kept(page) == want


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string")


def body(*lines):
    return "".join(f"<div>{x}</div>" for x in lines)


def test_shared_lines_of_the_nearest_page_go(spark):
    rows = [
        (1, "http://a.com/x/1", body("Top menu", "own 1", "both of the near", "Foot"), "old"),
        (2, "http://A.com/x/2?q", body("Top menu", "own 2", "both of the near", "Foot"), None),
        (3, "http://a.com/zz", body("Top menu", "own 3", "Foot", "other"), None),
        (4, "http://b.com/x/1", body("Top menu", "own 1", "Foot"), None),
        (5, None, body("no url"), None),
        (6, "http://c.com/1", None, None),
        (7, "http://d.com/1", "<article><p>same words</p></article>", None),
        (8, "http://d.com/1?again", "<article><p>same words</p></article>", None),
        (9, "http://d.com/2", "<p>page with</p><article><p>same words</p></article><p>unmarked</p>", None),
        (10, "http://e.com/1", body("copy", "of it"), None),
        (11, "http://e.com/1/", body("copy", "of it"), None),
    ]
    out = html.extract(pages(spark, [*rows, rows[0], rows[5]]))
    assert out.columns == ["page_id", "url", "text"]
    got = {}
    for r in out.collect():
        assert got.setdefault(r.page_id, r.text) == r.text
    assert out.count() == len(rows) + 2
    assert got == {
        1: "own 1", 2: "own 2", 3: "own 3\n\nother", 4: "Top menu\n\nown 1\n\nFoot", 5: "no url", 6: "", 7: "same words", 8: "same words",
        9: "page with\n\nsame words\n\nunmarked", 10: "copy\n\nof it", 11: "copy\n\nof it",
    }


def test_neighbours_do_not_depend_on_the_parts(spark):
    rows = [(i, f"http://h.org/{i:04}", body("Menu", f"own {i}", "Foot"), None) for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "7", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}
            assert got == {i: f"own {i}" for i in range(300)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runs_of_copies_take_a_partner_outside(spark):
    copies = [(i, f"http://h.org/a/{i:03}", body("Menu", *(f"same {j}" for j in range(20)), "Foot"), None) for i in range(6)]
    near = [(i, f"http://h.org/b/{i:03}", body("Menu", *(f"near {j}" for j in range(20)), f"own {i}", "Foot"), None) for i in range(10, 16)]
    other = [(20, "http://h.org/c/1", body("Menu", "else", "Foot"), None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "5", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r.page_id: r.text.split("\n\n") for r in html.extract(pages(spark, [*copies, *near, *other])).collect()}
            want = {i: [f"same {j}" for j in range(20)] for i in range(6)} | {i: [*(f"near {j}" for j in range(20)), f"own {i}"] for i in range(10, 16)} | {20: ["else"]}
            assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(spark):
    assert html.extract(pages(spark, [])).count() == 0


def test_query_over_all_pages(spark):
    """The articles of these pages are marked, so a plain extraction knows their text."""
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in queries.op2_html_extraction(spark, sf).collect()}
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", page.html, re.S)
        blocks = re.split(r"</?p>|</?h1>", inner[1].replace("<br>", " ") if inner else "")
        plain = [" ".join(entities.unescape(re.sub(r"<[^>]*(?:>|$)", "", b)).split()) for b in blocks]
        want = "\n\n".join(b for b in plain if b)
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (want, len(want))


@pytest.mark.parametrize("inside,text", [
    ('<p>See <a href="/hidden-gems">this page</a> now</p>', "See this page now"),
    ('<p aria-hidden="false">seen</p>', "seen"),
    ('<p title="hidden">seen</p>', "seen"),
    ("""<p title="a class='ad' b">seen</p>""", "seen"),
    ('<p data-class="ad">seen</p>', "seen"),
    ('<div class="search-and-rescue"><p>boats</p></div>', "boats"),
    ('<div class="related"><p>links</p></div>', ""),
    ('<div class="comment-list"><p>first!</p></div>', ""),
    ("<div hidden><p>no</p></div>", ""),
    ('<div class=x hidden=""><p>no</p></div>', ""),
    ("<div CLASS=ad><p>no</p></div>", ""),
])
def test_attributes_are_read_as_such(inside, text):
    for mark in ("<article>", '<article class="related-work">'):
        kept = [t for kind, t in html.lines_of(f"<body>{mark}{inside}</article></body>") if kind == html.KEEP]
        assert " ".join(kept) == text
