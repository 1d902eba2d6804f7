import random
import re

import pytest
from pyspark.sql import functions as F

from tripmart.llm import html_text as ht


def text(page, other=()):
    lines = ht.parse(page)
    return ht.main_text(lines, ht.shared([ht.signed(t) for t, _, _ in lines], [ht.signed(t) for t in other]))


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b</p>c", "a\nb\nc"),
    ("<nav>menu</nav><article><h1>T</h1><p>x  y\n z<br>w</p></article><footer>f</footer>", "T\nx y z w"),
    ('<div class="ad">buy</div><article><p>one<div class="ad-box">no</div></p><p>two</article> tail', "one\ntwo"),
    ('<main><header><h1>Title</h1></header><p>b</p><section class="comments"><article>c</article></section></main>', "Title\nb"),
    ("<article>a<script>var t='</p>';</script>b<!-- <p>no --><style>p{}</style>c</article>", "abc"),
    ('<div id="mainContent"><p>in</p></div><p>out</p>', "in"), ("<p>cut off <b>her", "cut off her"), ('<p title="a>b">t</p>', "t"),
    ("<article>open <!-- never closed", "open"), ("<p>1 < 2 &lt; 3 &am &copy;</p>", "1 < 2 < 3 &am ©"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<form><input value=x>f</form><div style='display:none'>h</div><p hidden>i</p><p>j</p>", "j"),
    ("<article><p>a&nbsp;b</p><aside>s</aside><table><tr><td>1</td><td>2</td></tr></table></article>", "a b\n1\n2"),
])
def test_markup(page, want):
    assert text(page) == want


BODY = "<p>The story has some words to tell.</p>"
TOLD = "The story has some words to tell."


@pytest.mark.parametrize("page,want", [
    (f"<div class='content has-sidebar'>{BODY}</div>", TOLD),
    (f"<div id='wrap' class='with-sidebar'><article>{BODY}</article></div>", TOLD),
    (f"<form action=x><div>menu</div><article>{BODY}</article><input></form>", TOLD),
    (f"<div class='post social-post'>{BODY}</div><p>x</p>", TOLD),
    (f"<article><div class='article-header'><h1>Head</h1></div>{BODY}</article>", f"Head\n{TOLD}"),
    (f"<article>Teaser</article><div class='content'>{BODY}{BODY}</div>", f"{TOLD}\n{TOLD}"),
    (f"<div class='content'><article>Teaser</article>{BODY}{BODY}</div>", f"Teaser\n{TOLD}\n{TOLD}"),
    (f"<div class='search-page'><main>{BODY}</main></div>", TOLD),
    # Junk that names itself stays out, however deep its content.
    (f"<article>{BODY}</article><div class='sidebar'><div class='content'>{BODY * 9}</div></div>", TOLD),
    (f"<article>{BODY}</article><div class='comments'><article>{BODY * 9}</article></div>", TOLD),
    (f"<article>{BODY}<div class='share'><article>no</article></div><form>f<main>no</main></form></article>", TOLD),
    (f"<article>{BODY}</article><div class='comment-content'>{BODY * 9}</div><footer><article>no</article></footer>", TOLD),
    (f"<main>{BODY * 5}<article>quoted</article></main><div class='sidebar'><article>also read</article></div>", "\n".join([TOLD] * 5 + ["quoted"])),
])
def test_frames_and_names(page, want):
    assert text(page) == want


def template(rng, k, stories):
    """A page without any named region: the site's lines around a story of its own, some of them at odd places."""
    site = [f"Site line {i}" for i in range(8)]
    own = [f"Story {k} line {i} " + " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 9))) for i in range(rng.randrange(1, 12))]
    lines = site[:4] + own[:2] + site[4:5] + own[2:] + site[5:]
    stories[k] = own
    return "".join(f"<div><span>{x}</span></div>" for x in lines)


def test_only_differencing_finds_stories_of_unnamed_templates(spark):
    """No tag and no name tells the story from the site; alignment with the page next to it does, as plain comparison confirms."""
    rng, stories = random.Random(2), {}
    rows = [(k, f"http://h{k % 3}.org/{'news' if k % 2 else 'shop'}/{k:03d}", template(rng, k, stories)) for k in range(60)]
    found = {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {k: "\n".join(lines) for k, lines in stories.items()}


def test_shared_lines_go_unless_an_article_holds_them():
    other = ["Home of news", "Story two", "All rights reserved"]
    assert text("<p>Home of news</p><p>Story one</p><p>All rights reserved</p>", other) == "Story one"
    assert text("<p>Home of news</p><article><p>Story two</p></article>", other) == "Story two"


def test_shared_equals_table():
    random.seed(8)
    for _ in range(200):
        a, b = ([random.randint(0, 4) for _ in range(random.randint(0, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(ht.shared(a, b))
        assert len(found) == table[-1][-1]
        at = 0
        for i in found:  # what is found stands in b in this order
            at = b.index(a[i], at) + 1


def test_pathological_pages_stay_linear():
    for page in ("<!--" * 50000, "<a " * 100000, '<a b="' * 30001, "&" * 100000, "<p>" * 50000, "<" * 100000, "<script>" * 20000):
        ht.parse(page)


def test_query_on_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = ht.op6_html_text(spark, sf).collect()
    assert len(rows) == len(pages)
    import html

    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_nearest_by_path_on_any_partitions(spark):
    line = lambda *ls: "".join(f"<p>{x}</p>" for x in ls)
    rows = [(1, "http://a.org/news/1", line("top", "one", "foot")), (2, "https://A.org/news/2?x=1", line("top", "two", "foot")),
            (3, "http://a.org/shop/1", line("cart", "three")), (4, "http://b.org/news/1", line("top", "four")), (5, None, line("five")),
            (6, "odd", None), (1, "http://a.org/news/1", line("top", "one", "foot")), (7, "http://a.org/shop/2", line("cart", "seven"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("near", F.lit("clash"))
    want = [(1, "one"), (1, "one"), (2, "two"), (3, "three"), (4, "top\nfour"), (5, "five"), (6, ""), (7, "seven")]
    for n in (1, 5):
        assert sorted((r.page_id, r.text) for r in ht.extract(df.repartition(n)).collect()) == want
    assert ht.extract(df.limit(0)).count() == 0
