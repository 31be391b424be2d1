import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import html_extract as hx
from tidewatch.llm import queries
from tidewatch.llm import url_filter as uf
from tidewatch.llm import url_labels as ul

from .util import clash

DATA = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"
LONG = "This is a paragraph of the article that is long enough and has many of the words that are common in it."


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a &amp; b&#33;&eacute;</p><p>c\n\t d</p>", "a & b!é\nc d"),
    ("<nav>menu</nav><article><h1>T</h1><p>one<br>two <b>bold</b><p>three</article><footer>f</footer>", "T\none two bold\nthree"),
    (f"<div class='sidebar'>{LONG}</div><div><p>{LONG}</p><p>short</p></div>", f"{LONG}\nshort"),
    (f"<script>var t='</p><p>x';</script><style>p</style><p>{LONG}</p><!-- c > --><form><p>{LONG}</p></form>", LONG),
    (f"<main><p>{LONG}</p><div id=comments><article><p>{LONG}</p></article></div></main>", LONG),
    (f"<article><p>{LONG}</p><div class='ad'>{LONG}</div><ul><li><a href='x'>a link</a></li></ul><p>end.</p></article>", f"{LONG}\nend."),
    ("<nav><article><p>kept though the menu was never closed</p></article>", "kept though the menu was never closed"),
    ("<p title='a > b'>x</p><p title=\"broken>y</p>", "x\ny"), ("<script>never closed <p>x</p>", ""), ("a < b <3 c", "a < b <3 c"),
])
def test_blocks(html, text):
    assert hx.main_text(html) == text


@pytest.mark.parametrize("html,text", [
    (f"<div class=content><p>{LONG}</p></div><div class=comments><article>{LONG} a</article></div>", LONG),
    *((f"<div><p>{LONG}</p></div><{t}><div><article><p>{LONG} teaser</p></article></div></{t}>", LONG) for t in ("aside", "nav", "header", "footer")),
    (f"<aside><article><p>{LONG} teaser</p></article></aside><article><p>{LONG}</p></article>", LONG),
    (f"<div><p>{LONG}</p></div><article>a short teaser</article>", f"{LONG}\na short teaser"),
    (f"<nav><ul><li>menu<article><p>{LONG}</p></article>", LONG),
])
def test_articles_in_boilerplate_are_not_the_main_text(html, text):
    assert hx.main_text(html) == text


@pytest.mark.parametrize("quote", ["'", '"'])
def test_long_attribute_values_are_read_whole(quote):
    value = "{a: 1 > 0, b: <article><nav>}" * 2_000
    page = f"<p>{LONG}</p><p data-x={quote}{value}{quote}>end</p><div data-x={quote}{value}{quote} class=ad><p>{LONG}</p></div>"
    assert hx.main_text(page) == f"{LONG}\nend"


@pytest.mark.parametrize("page", ["<p a='x' b=\"" * 40_001, "<p a=\"'" * 60_001 + ">", "<b " * 100_000, "<b a='" + "<b " * 100_000, "<p '>" * 50_001 + "<p \">" * 50_001,
                                  "<div " + "a" * 400_000 + ">", "<div a='" + "b" * 400_000 + "=\">"])
def test_odd_quotes_take_linear_time(page):
    import time

    t = time.time()
    hx.main_text(page)
    assert time.time() - t < 5


LINKS = "<ul>" + "<li><a href=x>a link</a></li>" * 5 + "</ul>"
KEYWORDS = "shoes boots sandals sneakers trainers loafers slippers clogs moccasins brogues oxfords derbies"


@pytest.mark.parametrize("html,text", [
    (f"<article><p>{LONG}</p>{LINKS}<p>Buy now!</p>{LINKS}</article>", LONG),
    (f"<article><p>{LONG}</p>{LINKS}<p>{KEYWORDS}</p>{LINKS}</article>", LONG),
    (f"<main><p>{LONG}</p>{LINKS}<p>{LONG}</p><p>short</p></main>", f"{LONG}\n{LONG}\nshort"),
    (f"<main><h1>T</h1><p>short</p>{LINKS}</main>", "T\nshort"),
    (f"<article><p>{KEYWORDS}</p></article><p>outside</p>", KEYWORDS),
])
def test_both_passes_inside_articles(html, text):
    assert hx.main_text(html) == text


def renamed(html, tags):
    return re.sub(rf"<(/?)(?:{tags})\b", r"<\1div", html)


def test_every_rule_decides(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    count = collections.Counter()
    for h in pages:
        count.update(hx.first_pass(b)[0] for b in hx.blocks(h))
        count.update("plain " + hx.first_pass(b)[0] for b in hx.blocks(renamed(h, "article|nav|footer")))
    assert all(count[x] > 0 for x in ("boilerplate", "stop words", "short", "few stop words", "plain links", "plain stop words", "plain short"))
    assert count["stop words"] > 1_000 and count["plain links"] > 1_000
    # without its elements an article is found by the passes alone, and menus go by their links
    assert sum(hx.main_text(h) == hx.main_text(renamed(h, "article")) for h in pages) >= 0.95 * len(pages)
    assert sum(hx.main_text(h) == hx.main_text(renamed(h, "article|nav")) for h in pages) >= 0.95 * len(pages)


def test_headings_go_with_what_follows():
    links = "<div>" + "<a href=x>some link</a><br>" * 9 + "</div>"
    assert hx.main_text(f"{links}<div><h1>T</h1><p>one</p><p>two</p><p>{LONG}</p></div>{links}") == f"T\none\ntwo\n{LONG}"
    assert hx.main_text(f"<p>{LONG} notice</p><article><p>{LONG}</p></article>") == LONG


def test_long_pages_take_linear_time():
    import time

    t = time.time()
    hx.main_text("<p>" * 100_000 + "x <b" * 50_000 + "<div>" * 20_000 + "&amp;" * 50_000)
    assert time.time() - t < 10


def test_extract_query_against_the_articles(spark):
    import html as h

    got = {r["page_id"]: r for r in queries.QUERIES["op4_html_extract"](spark, DATA).collect()}
    for r in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(h.unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]]["text"] == "\n".join(p for p in parts if p)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


def test_extract_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", f"<p>{LONG}</p>"), (3, "u", f"<p>{LONG}</p>"), (None, "u", "<p>🙂 é</p>")]
    got = hx.extract_html(clash(spark.createDataFrame(rows, PAGES))).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == sorted([("1", 0), ("2", 0), ("3", len(LONG)), ("3", len(LONG)), ("None", 3)])
    assert hx.extract_html(spark.createDataFrame([], PAGES)).count() == 0


def parse(url):
    rest = (url or "").partition("://")[2]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]


def rule(host, path):
    best = None
    for h, p, v in uf.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best


def test_rules_against_brute_force(spark):
    urls = [None, "", "x", "HTTP://WWW.Example.NET/en/1", "http://example.net", "http://example.net/", "http://a.example.net/en", "http://net/x", "https://xnet/x",
            "http://example.com/de/1?x#y", "http://b.org/fr/", "http://b.org/FR/", "http://É.org/fr/x", "a://b://c.net/d", "http://h.com?x=/de/", "http://h.net#/en/\nx", "//a.net/x"]
    d = clash(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    got = {r["page_id"]: r for r in uf.filter_urls(d, uf.UrlModel(base=-3.0)).collect()}
    for i, u in enumerate(urls):
        r = got[i]
        want = rule(*parse(u))
        assert (r["host"], r["path"]) == parse(u) and (r["rule"], r["verdict"]) == (want or (None, "allow"))


def test_trees_learn_held_out_hosts():
    r = np.random.default_rng(1)
    word = lambda n: "".join(r.choice(list("abcdefgh"), n))
    urls = [f"http://{word(6)}.com/{word(4)}/{r.integers(9)}" for _ in range(600)] + [f"http://{word(4)}-{word(5)}.com/{r.integers(10**9)}?a={r.integers(99)}&b=1" for _ in range(600)]
    y = np.repeat([0.0, 1.0], 600)
    m = uf.fit_trees(urls[::2], y[::2])
    assert np.mean((m.score(urls[1::2]) >= 0.5) == y[1::2]) > 0.97
    assert 0 < uf.fit_trees([], np.zeros(0)).score(["x"])[0] < 0.5 and len(m.score([])) == 0
    assert uf.fit_trees(["http://a.b/c"] * 9, np.ones(9)).score(["http://a.b/c"])[0] > 0.5


def test_url_query(spark):
    """Rules exactly; the method's verdicts on hosts that had labels and on hosts it never saw."""
    right = collections.defaultdict(list)
    for data in (DATA, "/root/testdata/sf0.1"):
        pages = spark.read.parquet(f"{data}/pages.parquet")
        got = {r["page_id"]: r for r in queries.QUERIES["op1_url_filter"](spark, data).collect()}
        assert len(got) == pages.count()
        marks = pages.select("page_id", "url", ul.unwanted(F.col("url")).alias("bad"), ul.unseen(F.col("url")).alias("unseen"))
        for r in marks.collect():
            g, want = got[r["page_id"]], rule(*parse(r["url"]))
            assert (g["host"], g["path"]) == parse(r["url"]) and g["rule"] == (want[0] if want else None)
            if want:
                assert g["verdict"] == want[1]
            else:
                right[r["unseen"], r["bad"]].append((g["verdict"] == "block") == r["bad"])
    assert len(right) == 4 and all(np.mean(v) > 0.9 for v in right.values()), {k: (np.mean(v), len(v)) for k, v in right.items()}


def test_url_odd_rows(spark):
    rows = [(1, "http://a.com/x"), (1, "http://a.com/x"), (2, None), (None, "http://a.com/x"), (3, "")]
    d = clash(spark.createDataFrame(rows, "page_id long, url string"))
    got = uf.filter_urls(d, uf.train_url_model(ul.labelled(d))).collect()
    assert len(got) == 5 and len({(r["host"], r["path"], r["verdict"], r["score"]) for r in got if r["host"]}) == 1
    none = spark.createDataFrame([], PAGES)
    assert uf.filter_urls(none, uf.train_url_model(ul.labelled(none))).count() == 0
