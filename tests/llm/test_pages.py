import html
import re

import pytest

from likertlake.llm import pages, queries


def text(page, template=frozenset()):
    return pages.main_text(pages.read(page), template)


CASES = [
    ("<article><h1>T &amp; x</h1><p>a  b\n c<br>d<p>e</article>", "T & x\na b c d\ne"),
    ("<body><nav>menu</nav><header>top</header><main><p>one</p><aside>side</aside></main><footer>f</footer>", "one"),
    ("<div class='cookie-notice'>ok</div><div id=content>text <b>bold</b>!</div><div class='comments'><p>hi</p></div>", "text bold!"),
    ("<article><header><h1>Title</h1></header><p>p1</p><div class='ad'>buy</div><form>q</form><section id='comments'>c</section></article>", "Title\np1"),
    ("<article><p>x<script>var a='</p>'</script><style>p{}</style><!-- no --> y</p></article>", "x y"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\nb\n1\n2\n3"),
    ("<main>intro<article><p>in</p></article></main>", "in"),
    ("<article><p>a</p></article><article class=post><p>b</p></article>", "a\nb"),
    ("<article><p>cut &amp; off &am", "cut & off &am"),
    ("<article><p>cut</p><div cla", "cut"),
    ("<article><p>1 < 2 &lt;b&gt; &#233;&nbsp;z</p></article>", "1 < 2 <b> é z"),
    ("<article><p>a<div>b</div>c</p></article></b></div>", "a\nb\nc"),
    ("plain text", "plain text"), ("", ""), ("<", ""), ("<article></article>", ""),
    ("<div hidden>x</div><div role=navigation>n</div><p>y", "y"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_main_text(page, want):
    assert text(page) == want


def test_deep_pages():
    assert text("<div>" * 20_000 + "x") == "x"
    assert pages.fingerprint(pages.read("<div>" * 5_000 + "x"))[1]


def test_query_against_the_articles(spark, sf_dir):
    """All pages of the data mark their article, whose blocks are headings and paragraphs."""
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op3_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(source)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|<footer|$)", source[r.page_id], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_templates_are_removed_by_count(spark):
    """No tag or name tells what belongs to the site; only that it recurs on its host."""
    def page(i, host, extra=""):
        return (i, f"https://User@{host}:8080/p/{i}", f"<div><a>Home</a> <a>About us</a></div><div><p>Story {i} of {host} {extra}</p></div><div>All rights reserved</div>")

    rows = [page(i, "a.example") for i in range(12)] + [page(i, "b.example") for i in range(12, 15)]
    rows += [page(i, "copy.example") for i in [99] * 20]  # one page many times is no template
    rows += [(200, None, rows[0][2]), (201, "no url", None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = pages.extract(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_id, set()).add(r.text)
    assert by[3] == {"Story 3 of a.example"}
    assert by[13] == {"Home About us\nStory 13 of b.example\nAll rights reserved"}
    assert by[99] == {"Home About us\nStory 99 of copy.example\nAll rights reserved"}
    assert by[200] == {"Home About us\nStory 0 of a.example\nAll rights reserved"} and by[201] == {""}
    again = {r.page_id: r.text for r in pages.extract(df, broadcast_hashes=0).collect()}
    assert all(by[k] == {v} for k, v in again.items())


def test_articles_are_kept_however_often_they_recur(spark):
    rows = [(i, f"http://h.example/{i}", f"<nav>menu</nav><article><p>the same words</p><p>{i}</p></article>") for i in range(20)]
    got = pages.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    assert {r.text for r in got} == {f"the same words\n{i}" for i in range(20)}


def test_site_blocks_inside_articles_go(spark):
    """A block that recurs in different articles goes; an article that is published again stays."""
    share, legal = "<div class=x1>Tell your friends</div>", "<p class=x2>All words are ours</p>"
    article = lambda i, host: (i, f"http://{host}/{i}", f"<article><h2>Facts</h2><div><p>Story {i}</p>{share}</div>{legal}</article>")
    main = lambda i: (i, f"http://m.example/{i}", f"<main><p>Story {i}</p><p>Tell your friends</p></main>")
    rows = [article(i, "h.example") for i in range(8)] + [main(i) for i in range(10, 18)]
    rows += [article(i, "small.example") for i in range(20, 23)]
    again = "<article><div><div>One story</div><p class=x>in two parts</p></div></article>"
    rows += [(i, f"http://again.example/{i}", f"<div>Page {i}</div>{again}") for i in range(30, 40)]
    body = f"<div><p>{'a long story ' * 100}</p></div>"
    rows += [(i, f"http://copies.example/{i}", f"<article>{body}<p>Read {i} times</p>{share}</article>") for i in range(40, 50)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert all(got[i] == f"Facts\nStory {i}" for i in range(8))
    assert all(got[i] == f"Story {i}" for i in range(10, 18))
    assert all(got[i] == f"Facts\nStory {i}\nTell your friends\nAll words are ours" for i in range(20, 23))
    assert all(got[i] == "One story\nin two parts" for i in range(30, 40))
    assert all(got[i] == f"{('a long story ' * 100).strip()}\nRead {i} times" for i in range(40, 50))


def test_sections_of_a_large_host_lose_their_menus(spark):
    """What is on the pages of one section of many is template, however large the host."""
    def page(s, i):
        return (s * 100 + i, f"http://big.example/s{s}/{i}", f"<div>Top</div><div>Menu of section {s}</div><div><p>Story {i} of {s}</p></div>")

    rows = [page(s, i) for s in range(30) for i in range(8)]
    got = pages.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {s * 100 + i: f"Story {i} of {s}" for s in range(30) for i in range(8)}


def test_formulas_sources_of_quotes_and_a_last_bracket_stay():
    text = lambda html: pages.main_text(pages.read(html), frozenset())
    assert text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p></article>") == "Let x=2 hold."
    quote = "<article><blockquote><p>So it is.</p><footer>A. Author</footer></blockquote><footer>Site</footer></article>"
    assert text(quote) == "So it is.\nA. Author"
    assert text("<article><p>if a <") == "if a <" and text("<article><p>if a <b") == "if a"


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, None), (1, "", ""), (1, "", "")], "page_id int, url string, html string").selectExpr("*", "'x' AS text", "'y' AS host", "'z' AS template")
    got = pages.extract(df).collect()
    assert [r.text for r in got] == ["", "", ""] and {r.host for r in got} == {"y"}
    assert pages.extract(df.limit(0)).collect() == []
