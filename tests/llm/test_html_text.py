import html
import random
import re

from cupola.llm import html_text

D = "/root/testdata/sf0.01"


def by_markup(page):
    """The given pages mark their article plainly: its blocks, read by a few patterns."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|article|body|html)[^>]*>", re.sub(r"<br>", " ", body))
    return "\n".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if t)


def test_given_pages(spark):
    from cupola.llm.queries import op3_html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{D}/pages.parquet").collect()}
    got = op3_html(spark, D).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == by_markup(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def page(body, head=""):
    return f"<html><head><title>t</title>{head}</head><body>{body}</body></html>"


def text_of(spark, rows):
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, row int"))
    return {r["page_id"]: r["text"] for r in got.collect()}


def test_markup():
    cases = {
        "<div class='ad box'>buy</div><p>one&nbsp;&amp; two<p>three<br>four": ["one & two", "three four"],
        "<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>x <b>y</b>z</p><footer>by</footer></article><p>after</p>": ["Title", "x yz"],
        "<main><form>f</form><section id='comments'><p>c</p></section><p>a &lt;b&gt; <i>c</p><!-- no --></main>": ["a <b> c"],
        "<script>var t='</p>';</script><style>p{}</style><p>5 < 6 and 7 > 3</p>": ["5 < 6 and 7 > 3"],
        "<p title='a > b'>quoted</p><p>cut <a href='x": ["quoted", "cut"],
        "<nav><ul><li>m</li></ul></nav><aside>s</aside><div role=\"navigation\">n</div><p>kept</p>": ["kept"],
        "<p>old news</p><div class='headline'>h</div><div class='addition'>more</div>": ["old news", "h", "more"],
        "<article><p>broken &am": ["broken &am"],
    }
    for body, want in cases.items():
        assert html_text.read(body)[0] == want


def test_articles_are_kept_whole():
    cases = {
        # names on an element around the article
        "<div class='layout has-sidebar'><article><p>A</p></article></div>": ["A"],
        "<div id='main-banner-free'><main><p>A</p></main></div>": ["A"],
        "<div class='page banner'><article>A</article></div>": ["A"],
        "<body class='no-comments'><p>b</p>": ["b"],
        # but not where the page has another article, nor those of comments and lists
        "<div class='sidebar'><article>t</article></div><article>A<div class='related-posts'><article>t</article></div></article>": ["A"],
        "<div class='comments'><article>c</article></div><p>q</p>": ["q"],
        "<article>A</article><article class='comment'>c</article><article id='comment-4'>d</article>": ["A"],
        "<article>A<nav><article>n</article></nav></article>": ["A"],
        # elements without content, left open, or closed in their own tag
        "<article><p>a<img class='social-icon'>b</p><input class='search'><p>c</p></article>": ["ab", "c"],
        "<article><svg class='x'/><p>a</p><button>go<p>b</p></article>": ["a", "b"],
        "<article><button><b>x</b></button><p>a</p><select><option>y<p>b</p><select></select>c</article>": ["a", "b", "c"],
        # hidden as an attribute, not as a part of another
        "<article><div style='overflow:hidden'>a</div><div data-hidden='false'>b</div><p hidden>c</p><p style='display: none'>d</p></article>": ["a", "b"],
        "<article><p hidden='until-found'>a</p><div aria-hidden='false'>b</div><div aria-hidden='true'>c</div></article>": ["a", "b"],
        "<article><p>x <math><mi>y</mi><annotation-xml>z</annotation-xml></math></p><div class='related-work'>w</div></article>": ["x y", "w"],
        "<p>a <span class='ad'>x<span>y</span>AD</span> b</p>": ["a b"],
        "<head><title>t</title><p>the head was never closed</p>": ["the head was never closed"],
    }
    for body, want in cases.items():
        assert html_text.read(body)[0] == want, body


def test_longest_common_subsequence():
    rng = random.Random(2)

    def best(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = sorted(html_text.shared(a, b))
        assert len(got) == best(a, b)
        it = iter(b)
        assert all(a[i] in it for i in got)


def test_nearest_url_differencing(spark):
    frame = lambda main: page(f"<div>Welcome to the site</div><div>Top stories</div>{main}<div>All rights reserved</div>")
    rows = [(i, f"http://h.example/news/{i}{tail}", frame(f"<p>Story number {i}</p><p>It goes on {i}</p>"), None, 1)
            for i, tail in ((10, ""), (11, "/"), (12, ".html?x=1"), (13, "#top"))]
    rows += [(20, "http://h.example/shop/1", page("<div>Buy things</div><div>Top stories</div>"), None, 1)]
    rows += [(30, "http://alone.example/a", frame("<p>Alone here</p>"), None, 1)]
    rows += [(40, "http://m.example/a", frame("<p>Mirror</p>"), None, 1), (41, "http://m.example/b", frame("<p>Mirror</p>"), None, 1)]
    got = text_of(spark, rows)
    for i in (10, 11, 12, 13):
        assert got[i] == f"Story number {i}\nIt goes on {i}"
    assert got[30] == "Welcome to the site\nTop stories\nAlone here\nAll rights reserved"
    assert got[40] == got[41] == "Welcome to the site\nTop stories\nMirror\nAll rights reserved"


def test_neighbours_across_range_partitions(spark):
    rows = [(i, f"http://h{i % 3}.example/p/{i:03d}", page(f"<div>Frame of {i % 3}</div><p>Own {i}</p>"), None, 1) for i in range(60)]
    got = text_of(spark, rows)
    assert got == {i: f"Own {i}" for i in range(60)}


def test_edges(spark):
    rows = [(None, None, None, None, None), (1, None, "", "x", 1), (2, "no url", "plain words", "x", 1), (2, "no url", "plain words", "x", 1),
            (3, "http://a.example/1", "<p>" + "long words " * 50000, "x", 1), (4, "http://a.example/2", "<" * 3000 + "<p>x", "x", 1)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, row int"))
    assert got.count() == len(rows)
    d = {r["page_id"]: r["text"] for r in got.collect()}
    assert (d[None], d[1], d[2]) == ("", "", "plain words") and len(d[3]) == 11 * 50000 - 1
    assert html_text.extract(got.limit(0).withColumn("html", got["text"])).count() == 0


def test_marked_pages_are_differenced_and_checked(spark):
    head, foot = "<nav><li>Home</li><li>News</li></nav><div>Top stories</div>", "<div>All rights reserved</div>"
    rows = [(i, f"http://h.example/news/{i}", page(f"{head}<div class='ad'>Buy {i}</div><article><p>Same words</p><p>Story {i}</p></article>{foot}"), None, 1) for i in (1, 2, 3)]
    rows += [(4, "http://h.example/news/4", page(f"{head}<p>Same words</p><p>Unmarked</p>{foot}"), None, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, row int")
    got = {r["page_id"]: tuple(r)[2:] for r in html_text.extract(df).collect()}
    # differencing deletes menu, heading and foot of every page; the check restores a shared line of the article and deletes the advert
    assert got[1] == ("Same words\nStory 1", 4, 1, 1)
    assert got[2] == ("Same words\nStory 2", 4, 1, 1)
    assert got[4] == ("Unmarked", 5, 0, 0)


def test_every_given_page_is_differenced(spark):
    from cupola.llm.queries import op3_html

    got = op3_html(spark, D).collect()
    assert sum(r["n_frame"] for r in got) > 0 and sum(r["n_restored"] for r in got) > 0  # no line of these pages reached differencing before
