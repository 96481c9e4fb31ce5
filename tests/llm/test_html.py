"""Main-text extraction against plain versions."""
import html as entities
import re

import duckdb

from ledgerlake.llm import queries
from ledgerlake.llm.html import extract, extract_pages, score_containers
from tests.conftest import SF01

SCHEMA = "page_id long, url string, html string, path string, host string, text string, salt int"


def plain(page):
    """The article of the test pages, cut out by position."""
    m = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    if not m:
        return ""
    return " ".join(entities.unescape(re.sub(r"</?b>", "", re.sub(r"<(br|/?p|/?h1)>", "\n", m[1]))).split())


def test_query_on_all_pages(spark):
    rows = duckdb.sql(f"select page_id, url, html from read_parquet('{SF01}/pages.parquet')").fetchall()
    got = {r.page_id: r for r in queries.op3_html_extract(spark, SF01).collect()}
    assert len(got) == len(rows)
    for i, url, page in rows:
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, plain(page), len(plain(page)))


BODY = "".join(f"<p>Paragraph {i} of the story, long enough to weigh something.</p>" for i in range(6))
WANT = " ".join(f"Paragraph {i} of the story, long enough to weigh something." for i in range(6))
CHROME = ("<header><a href=/>Home</a> Site name</header><nav><ul><li>One menu entry that is long</ul></nav>"
          "<div class='cookie-notice'>We use cookies to do a number of things, read the long policy here</div>")
TAIL = ("<aside class=sidebar><p>Side text side text side text side text</p></aside>"
        "<div id=comments><p>A reader wrote a very long comment. " + "blah " * 300 + "</p></div>"
        "<form><p>Write to us <input name=q></p></form><footer>&copy; all rights</footer>")


def test_templates():
    page = f"<html><body>{CHROME}<div class='post content-12'><h1>Title &amp; more</h1>{BODY}</div>{TAIL}</body></html>"
    assert extract(page, None) == f"Title & more {WANT}"
    inner = page.replace(BODY, BODY[:60] + "<nav>inner menu</nav><div class=ad>Buy now</div><script>var p='</p>'</script>" + BODY[60:])
    assert extract(inner, None).startswith("Title & more Paragraph 0")
    assert "Buy now" not in extract(inner, None) and "menu" not in extract(inner, None)


def test_malformed_markup():
    assert extract("<article><p><b>One<br><p>two &am<p>th<i>re</i>e", None) == "One two &am three"
    assert extract("<article>a<!-- <p>no</p> -->b <p>x\n\n y&nbsp;&#233;</p></article", None) == "ab x y é"
    assert extract("plain text only", None) == "plain text only"
    assert extract("<ul><li>a<li>b</ul><p>c</p></p></div>d<style>p{}", None) == "a b c d"
    assert extract("<p>1 < 2 and <3</p>", None) == "1 < 2 and <3"
    assert extract("", None) == extract("<div></div>", None) == extract("<script>x", None) == ""


def test_host_consensus(spark):
    short = "<html><body><div class=teaser><p>Longer than the article on this page only</p></div><div class=post-1><p>Short.</p></div></body></html>"
    long = f"<html><body><div class=teaser><p>Teaser</p></div><div class=post-1>{BODY}</div></body></html>"
    other = f"<html><body><section>{BODY}</section></body></html>"
    assert max(score_containers(short).items(), key=lambda x: x[1])[0].endswith("teaser")
    rows = [(i, "http://h.example.com/x", long) for i in range(5)] + [(6, "https://H.example.com:80/y?z", short)]
    rows += [(7, "http://h.example.com/z", other), (8, None, None), (9, "", ""), (None, "::", other)]
    rows += [(10, "http://h.example.com/r", long)] * 2
    df = spark.createDataFrame([(*r, "", "", "", 0) for r in rows], SCHEMA)
    got = extract_pages(df).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[6] == "Short."                        # the host's path, not the page's best container
    assert text[0] == text[7] == text[10] == text[None] == WANT
    assert text[8] == text[9] == ""
    assert extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_page(spark):
    page = "<article>" + "<p>word word</p>" * 100_000 + "</article>"
    assert len(extract(page, "html/article")) == 100_000 * 10 - 1


def test_blocks_beside_the_best_container(spark):
    p = lambda t, n: "".join(f"<p>{t} {i} of a text long enough to weigh.</p>" for i in range(n))
    flat = lambda h: " ".join(re.sub("<[^>]*>", " ", h).split())
    parts = [f"<article><h1>T</h1><p>lead</p><div class=entry-content>{p('Body', 20)}</div></article>",
             f"<main><h1>T</h1><article><h2>S</h2><div><div class=text>{p('Body', 20)}</div></div></article></main>",
             f"<div class=post><p>lead text</p><div class=section>{p('A', 20)}</div><div class=section>{p('B', 20)}</div></div>",
             f"<div class=post><p>lead text</p><section class=a>{p('A', 40)}</section><section class=b>{p('B', 4)}</section></div>",
             f"<div>{p('Before', 2)}<ul>{p('Item', 20).replace('p>', 'li>')}</ul><p>After.</p></div>",
             f"<div><p>Before.</p><table><tr><td>{p('Cell', 20)}</td></tr></table></div>"]
    pages = [f"<html><body>{CHROME}{x}<div class=teaser><div>Read on at another place</div></div>{TAIL}</body></html>" for x in parts]
    for part, page in zip(parts, pages):
        assert extract(page, None) == flat(part)
    rows = [(10 * i + j, f"http://h{i}.example.com/{j}", x, "", "", "", 0) for i, x in enumerate(pages) for j in range(3)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {10 * i + j: flat(x) for i, x in enumerate(parts) for j in range(3)}
    # further articles in a main element, and columns beside the text, stay out
    cards = f"<main><article class=post>{p('Body', 20)}</article><article class=card>Another story</article></main>"
    assert extract(cards, None) == flat(p("Body", 20))
    rail = f"<div id=wrap><h1>Site</h1><div class=content>{p('Body', 30)}</div><div class=rail><div>{'rail ' * 60}</div></div></div>"
    assert extract(rail, None) == flat(p("Body", 30))


def test_wrappers_named_like_boilerplate():
    for name in ("content with-sidebar", "no-sidebar", "header-fixed", "page nav-open", "post category-social tag-ads"):
        for inner in (BODY, f"<article>{BODY}</article>", f"<div class='entry tag-ads'>{BODY}</div>", f"<div>{BODY}</div>"):
            page = f"<html><body>{CHROME}<div class='{name}'>{inner}<div class=sidebar><p>Side text</p></div></div>{TAIL}</body></html>"
            assert extract(page, None) == WANT, (name, inner[:30])
    side = "<div class=sidebar><div class=post>" + "<p>Side text of a column</p>" * 3 + "</div></div>"
    assert extract(f"<body><div class=nav-open><div class=x>{BODY}</div>{side}</div></body>", None) == WANT
    related = "<div class=related>" + "<article class=card>Some other story</article>" * 3 + "</div>"
    assert extract(f"<body><div class=x>{BODY}</div>{related}</body>", None) == WANT
    thread = "<div class=comments><article class=comment-body><p>" + "blah " * 500 + "</p></article></div>"
    assert extract(f"<body><article>{BODY}</article>{thread}</body>", None) == WANT
    assert extract("<body><div class=banner>All there is</div><nav>Menu</nav></body>", None) == "All there is"
    assert extract("<body><nav>Menu</nav><p hidden>no</p></body>", None) == ""
