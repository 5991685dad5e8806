import itertools
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from sparkloom.functions import html as H, urls as U

BASES = [
    "https://x.test/animals/",
    "https://x.test/animals/cat",
    "https://x.test",
    "http://x.test:8080/a/b/c.html?q=1#top",
    "https://x.test/a;p/b;q=1?x",
]
HREFS = [
    "", "a", "a/b/", "../a", "../../../a", "./a/./b", "..", ".", "a/..", "a/../../b", "/r", "/r/../s", "/r//s", "//h.test/p/../q",
    "?q=2", "#f", "a?b#c", "https://h.test/a#", "HTTP://h.test/b?", "mailto:a@b", "javascript:void(0)", "/x#", "/x?#", " /pad", "a//b", "x;y/z",
]


def test_resolving_matches_the_standard_library(spark):
    pairs = list(itertools.product(BASES, HREFS))
    df = spark.createDataFrame(pairs, "base string, href string")
    rows = df.select("base", "href", U.resolve_url(F.col("base"), F.col("href")).alias("got")).collect()
    wrong = [(r.base, r.href, r.got, urljoin(r.base, r.href)) for r in rows if r.got != urljoin(r.base, r.href)]
    assert not wrong


def test_parts_match_the_standard_library(evaluate):
    urls = BASES + [urljoin(b, h) for b, h in itertools.product(BASES, HREFS)]
    assert evaluate(U.url_path, urls) == [urlparse(u).path for u in urls]
    assert evaluate(U.url_netloc, urls) == [urlparse(u).netloc for u in urls]


def test_slugs_and_filters(evaluate):
    assert evaluate(U.url_slug, ["https://x.test/animals/red-fox/", "https://x.test/", "https://x.test/a.html?q"]) == [
        "animals_red-fox.html", "index.html", "a.html",
    ]
    urls = ["https://x.test/animals/", "https://x.test/animals/cat", "https://x.test//animals/cat/", "https://x.test/animals//x", "https://x.test/zoo/cat"]
    assert evaluate(U.is_detail_page, urls) == [False, True, True, False, False]
    assert evaluate(U.is_valid_link, ["https://x.test/LISTS/a", "https://x.test/a?/lists/"]) == [False, True]


def test_links_leave_the_header_out_and_keep_page_order(spark):
    html = (
        "<div id='headerNav'><a href='/nav'>n</a></div><a class=x href=\"/b\">b</a><A HREF='a?x'>a</A>"
        "<a href='https://other.test/'>o</a><a href='/b'>again</a><a\nhref='c'>c</a>"
    )
    df = spark.createDataFrame([("https://x.test/d/e", html)], "url string, html string")
    got = df.select(H.site_links(F.col("url"), F.col("html")).alias("links")).first()["links"]
    assert got == ["https://x.test/b", "https://x.test/d/a?x", "https://x.test/d/c"]
