import random

import pytest

from starling.llm import html_text as H

SCHEMA = "page_id long, url string, html string"


def lcs_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("cells", [1 << 28, 10])  # whole, and split in halves
def test_common_lines_is_a_longest_common_subsequence(cells):
    rng = random.Random(5)
    for _ in range(400):
        k = rng.choice([2, 4, 30])
        a, b = ([rng.randrange(k) for _ in range(rng.randrange(25))] for _ in range(2))
        index = H.common_lines(a, b, cells)
        assert index == sorted(set(index)) and len(index) == lcs_length(a, b)
        rest = iter(b)
        assert all(x in rest for x in (a[i] for i in index))


@pytest.mark.parametrize("page,want", [
    ("<article><h1>T &amp; U</h1><p>one\n  two</p><p>x<br>y<b>z</b></article>", ["T & U", "one two", "x yz"]),
    ("<nav>menu</nav><main><p>a</p><aside>b</aside><p>c</p></main><footer>f</footer>", ["a", "c"]),
    ("<header>h</header><article><header><h2>t</h2></header>b</article>", ["t", "b"]),
    ("<article>a<script>var x='</p>';</script>b<style>p{}</style><!-- c -->d</article>", ["abd"]),
    ("<article><p>x<div class='ad-box'>buy</div><p>y<section id=comments><p>hi</section></article>", ["x", "y"]),
    ("<div class=cookieNotice>c</div><article><form>f<input></form>&lt;p&gt; &#8364;&nbsp;5</article>", ["<p> € 5"]),
    ("<article><p>unclosed <i>tags <p>here", ["unclosed tags", "here"]),
    ("<p hidden>x</p><div role=navigation>n</div>a &lt b < c > d", ["a < b < c > d"]),
    ("", []), ("<article></article>", []), ("<", ["<"]), ("<!-- open", []), ("<a href='x", []),
])
def test_lines_of_a_page(page, want):
    assert [t for t, role in H.page_lines(page) if role != H.FURNITURE] == want


@pytest.mark.parametrize("page,want", [
    ('<div class="layout has-sidebar"><article><p>a<p>b</article></div>', ["a", "b"]),
    ('<article class="post comments-open"><p>a</article>', ["a"]),
    ('<main id="search-content"><p>a</main>', ["a"]),
    ('<article><p>a<p class="notice-text">b<section class="related-work"><p>c</section></article>', ["a", "b", "c"]),
    ('<div class=widget><div id=promo><article class=ad>a</article></div></div><div class=widget>w</div>', ["a"]),
    ('<main><div class="sidebar"><article>a</article></div></main>', ["a"]),
    # still furniture: whole names, also around articles when the page has a main text, and tags
    ('<article>a</article><div class="sidebar-wrap x">s</div><ol class=comments><li><article>c</article></ol>', ["a"]),
    ('<div class="ad top"><nav><article>n</article></nav>b</div><article>a</article>', ["a"]),
])
def test_class_names_do_not_take_the_article(page, want):
    assert [t for t, role in H.page_lines(page) if role != H.FURNITURE] == want


def test_many_marked_wrappers_are_read_twice():
    assert H.page_lines("<div class=ad>" * 3000 + "<article>a") == [("a", H.MAIN)]


def site(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_shared_open_lines_go_and_article_lines_stay(spark):
    body = "<body><div>Top</div><div>Second</div><div>{}</div><div>{}</div><div>Bottom</div></body>"
    rows = [(i, f"http://h.com/a/{i:03d}", body.format(f"text {i}", f"more {i}")) for i in range(40)]
    rows += [(100 + i, f"http://k.com/{i}", f"<article><p>same</p><p>own {i}</p></article><div>bar</div>") for i in range(6)]
    rows += [(200, None, None), (201, "", ""), (202, "http://solo.com/x", body.format("u", "v")), (203, "http://[bad", "<p>z"),
             (204, "http://twin.com/x", body.format("t", "t")), (204, "http://twin.com/x", body.format("t", "t"))]
    got = {r.page_id: r for r in H.main_text(site(spark, rows)).collect()}
    assert len(got) == len({r[0] for r in rows})
    for i in range(40):
        assert got[i].text == f"text {i}\nmore {i}" and got[i].n_chars == len(got[i].text) and got[i].n_shared == 3
    for i in range(6):
        assert got[100 + i].text == f"same\nown {i}"
    assert got[200].text == "" and got[201].text == "" and got[203].text == "z"
    assert got[202].text == "Top\nSecond\nu\nv\nBottom"   # no neighbour
    assert got[204].text == "Top\nSecond\nt\nt\nBottom"   # an equal page is no neighbour


def test_neighbours_follow_the_path_order_across_partitions(spark):
    paths = [f"/{'abc'[i % 3]}/{i % 7}/{i:02d}" for i in range(60)]
    rows = [(i, f"http://{'xy'[i % 2]}.com{p}", f"<p>{i}") for i, p in enumerate(paths)]
    parsed = H.parsed_pages(site(spark, rows, 5))
    name = {r.row: (r.host, r.path) for r in parsed.collect()}
    near = {name[r.row]: name[r.near] for r in H.neighbours(parsed).collect()}
    order = sorted(name.values())

    def shared(a, b):
        n = 0
        for x, y in zip(a.split("/"), b.split("/")):
            if x != y:
                break
            n += 1
        return n
    for i, me in enumerate(order):
        around = [order[j] for j in (i - 1, i + 1) if 0 <= j < len(order) and order[j][0] == me[0]]
        assert near[me] == max(around, key=lambda o: shared(o[1], me[1]))


def test_equal_pages_meet_the_nearest_other_page(spark):
    body = '<div class="content"><p>{}</p></div><div>Site bar</div>'
    rows = [(1, "http://a.com/x/1", body.format("crawled twice")), (2, "http://a.com/x/1", body.format("crawled twice")),
            (3, "http://a.com/z", body.format("crawled twice")), (4, "http://a.com/x/2", body.format("another")),
            # every line of page 5 stands on its neighbour, page 6, too
            (5, "http://b.com/1", body.format("part")), (6, "http://b.com/2", body.format("part") + "<p>more</p>")]
    rows += [(100 + i, "http://a.com/x/1", body.format("crawled twice")) for i in range(300)]
    got = {r.page_id: r.text for r in H.main_text(site(spark, rows, 6)).collect()}
    assert {got[i] for i in [1, 2, 3, *range(100, 400)]} == {"crawled twice"}
    assert got[4] == "another" and got[5] == "part\nSite bar" and got[6] == "more"


def test_empty_clashing_and_repeated(spark):
    from pyspark.sql import functions as F
    assert H.main_text(spark.createDataFrame([], SCHEMA)).count() == 0
    df = site(spark, [(1, "http://a.com/x", "<article>t</article>")] * 3)
    for c in ("text", "row", "host", "path", "lines", "near"):
        df = df.withColumn(c, F.lit("clash"))
    assert [r.text for r in H.main_text(df).collect()] == ["t"] * 3
