import pytest

from sparkloom.llm import extract


def text(page, others=()):
    """Main text by a wrapper of the page itself, or of other pages."""
    return extract.main_text(page, extract.content_paths(extract.infer([*others] or [page])))


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li>menu</li></ul></nav><!-- ad -->
    <div class="ad">buy</div><article><h1>T &amp; t</h1><p><b>one
      two<br>three<p>four &lt;b&gt; &#233;</p><aside>side</aside><div class="cookie-notice">c</div><form><p>f</p></form><ul><li>a<li>b</ul>
      <section id="comments"><p>said</p></section></article><footer>&copy; x</footer></body></html>"""
    assert text(page) == "T & t\n\none two three\n\nfour <b> é\n\na\n\nb"


def test_entities_are_decoded_once():
    assert text("<article><p>&amp;lt;p&amp;gt; a&nbsp;&nbsp; b</p></article>") == "&lt;p&gt; a b"


def test_broken_pages():
    assert text("") == "" and text("plain words") == "plain words"
    assert text("<article><p>a<div>b") == "a\n\nb"
    assert text("</div></p><article><p>a < b and c</p><script>x") == "a < b and c"
    assert text("<p title='a>b' class=x>q</p>") == "q"
    assert len(text("<article>" + "<p>word" * 50_000)) == 50_000 * 6 - 2


def test_odd_markup_takes_linear_time():
    for page in ("<a" * 100_000, "<a" * 100_000 + ">", "<" * 200_000, "<!--" * 50_000, "<script>" * 30_000, "<a '" * 60_000, "<div>" * 30_000, "</div>" * 30_000, "<div>" * 30_000 + "</nav>" * 30_000, "&amp" * 50_000):
        text(page)
    assert text("<article><p>kept") == "kept" and text("a <!-- b") == "a" and text("a <b") == "a <b"


def test_root_is_inferred_from_what_varies():
    def page(k):
        return f'<body><div class="top"><p>Same</p></div><div class="post"><p>Text {k} a</p><p>Text {k} b</p></div><div class="links"><p>Fixed one</p><p>Fixed two</p><p>Fixed 3</p></div></body>'

    assert extract.content_root(extract.infer([page(k) for k in range(4)])) == "div class=post"
    assert text(page(9), [page(k) for k in range(4)]) == "Text 9 a\n\nText 9 b"


def test_siblings_of_the_largest_part_stay():
    def post(k):
        return f'<body><div class="top">Same</div><div class="post"><h1>T{k}</h1><p>Intro {k}</p><ul><li>{f"long item {k} " * 40}</li></ul></div><div class="links">Fixed</div></body>'

    def nested(k):
        return f'<body><div id="content"><p>First {k}</p><div class="section"><p>{f"second {k} " * 40}</p></div></div><div class="links"><p>Fixed</p></div></body>'

    def plain(k):
        return f'<body><div>Head</div><p>Lead {k}</p><table><tr><td>{f"cell {k} " * 40}</td></tr></table><div class="box">Fixed</div></body>'

    for page, want in ((post, ["T9", "Intro 9", ("long item 9 " * 40).strip()]), (nested, ["First 9", ("second 9 " * 40).strip()]), (plain, ["Lead 9", ("cell 9 " * 40).strip()])):
        assert text(page(9), [page(k) for k in range(4)]) == "\n\n".join(want)
        assert "\n\n".join(want) in text(page(9))


def test_long_irregular_pages_are_aligned():
    import random

    rng = random.Random(1)
    pages = ["<article>" + "".join(rng.choice(("<p>a</p>", "<h2>b</h2>", "<ul><li>c</li></ul>", "<div>d</div>", "e")) for _ in range(4000)) + "</article><footer>f</footer>" for _ in range(8)]
    paths = extract.content_paths(extract.infer(pages))
    assert paths[" > article > div"] and not paths[" > footer"]
    assert extract.main_text(pages[0], paths).count("\n\n") > 3000


def test_alignment_keeps_a_longest_common_subsequence():
    import random

    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        for bound in (1, 50, 10**6):
            pairs = extract._matched(a, b, bound)
            assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_long_middles_become_slots():
    import random

    rng = random.Random(4)

    def page(k):
        parts = "".join(f"<{(t := rng.choice(('p', 'h2', 'pre', 'h3')))} class=c{rng.randint(0, 9)}>text {k}.{i}</{t}>" for i in range(600))
        return f'<body><div class="post">{parts}</div><div class="top"><p>Day {k}</p></div></body>'

    nodes = extract.infer([page(k) for k in range(4)])
    assert extract.content_root(nodes) == "div class=post"
    assert sum(kind == "text" and node[1] is None for kind, _, node in extract._events(nodes)) > 600


def test_long_groups_repeat():
    group = "".join(f"<p class=c{k}>x</p>" for k in range(40))
    assert extract.expression(extract.infer([group * 3])).count("<p class=c7>") == 1


def test_pages_that_the_wrapper_has_not_seen():
    seen = [f'<body><div class="menu">m</div><article><p>Text {k}</p></article></body>' for k in range(3)]
    assert text('<body><article><div class="quote">Q</div><div class="share">s</div><p>P</p></article></body>', seen) == "Q\n\nP"
    assert text('<body><div class="page"><article><p>Deep</p></article></div><div>other</div></body>', seen) == "Deep"
    assert text('<body><div class="old"><p>Plain</p></div></body>', seen) == "Plain"
    assert text("", seen) == ""


def test_wrappers_generalise():
    pages = ["<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>c</li></ul><h2>n</h2><p>y</p>", "<ul><li>c</li><li>c</li><li>d</li></ul><p>y</p>"]
    assert extract.expression(extract.infer(pages)) == '<ul>(<li>#</li>)+</ul>(<h2>"n"</h2>)?<p>#</p>'
    assert extract.expression(extract.infer(pages[:1])) == '<ul>(<li>#</li>)+</ul><p>"x"</p>'


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as root", "2 as host", "3 as text", "'x' as order")

    return make


def test_rows(pages, monkeypatch):
    rows = [(1, "http://a.b/x", "<article><p>é one</p></article>"), (2, "http://a.b/y", None), (3, None, "<p>no host</p>"), (None, "http://c.d/", ""), (1, "http://a.b/x", "<article><p>é one</p></article>")]
    want = sorted([(1, "http://a.b/x", "é one", 5), (2, "http://a.b/y", "", 0), (3, None, "no host", 7), (None, "http://c.d/", "", 0), (1, "http://a.b/x", "é one", 5)], key=repr)

    def got():
        return sorted((tuple(r) for r in extract.page_texts(pages(rows)).select("page_id", "url", "text", "n_chars").collect()), key=repr)

    assert got() == want
    monkeypatch.setattr(extract, "BROADCAST_BYTES", -1)
    assert got() == want
    assert extract.page_texts(pages(rows).limit(0)).count() == 0


def test_same_texts_of_all_pages_are_left_out(pages):
    """Without class names to go by: an advert in every article, a rare template's notice, a hot host of copies."""

    def html(k):
        rare = '<div class="r"><p>Rare but always the same</p></div>' if k % 20 == 0 else ""
        own = f"<div><p>Own part {k}</p></div>" if k % 2 else ""
        return f"<body><article><h1>T{k}</h1><div><p>Buy</p><p>now</p></div><p>{f'word {k} ' * 20}</p>{own}{rare}<blockquote>Quote {k % 40}</blockquote></article></body>"

    def want(k):
        return "\n\n".join([f"T{k}", (f"word {k} " * 20).strip(), *([f"Own part {k}"] if k % 2 else []), f"Quote {k % 40}"])

    copy = "<body><article><h1>Same</h1><div><p>copied</p></div><section><p>all of it is one text</p></section></article></body>"
    rows = [(k, "http://a.b/", html(k)) for k in range(400)] + [(1000 + k, "http://c.d/", copy) for k in range(50)]
    got = {r["page_id"]: r["text"] for r in extract.page_texts(pages(rows)).collect()}
    assert all(got[k] == want(k) for k in range(400))
    assert {got[1000 + k] for k in range(50)} == {"Same\n\ncopied\n\nall of it is one text"}


def test_copies_under_changing_titles_stay(pages):
    rows = [(k, "http://a.b/", f"<article><h1>Title {k}</h1><div><p>{'shared text ' * 20}</p></div></article>") for k in range(30)]
    assert all(r["text"].endswith("shared text") for r in extract.page_texts(pages(rows)).collect())


def test_container_keys_tell_path_and_text():
    def rows(page):
        return {key for _, key, _ in extract.container_rows(page, extract.content_paths(extract.infer([page])))}

    page = "<article><p>{0}</p><div><p>a</p><p>b</p></div><section>{1}</section></article>".format("long " * 9, "{}")
    assert rows(page.format("c")) & rows(page.format("d")) and len(rows(page.format("c")) ^ rows(page.format("d"))) == 2
    assert not rows("<article><p>long long</p><div>ab</div></article>") & rows("<article><p>long long</p><ul>ab</ul></article>")
    deep = "<article><p>" + "w " * 50 + "</p>" + "<div>" * 5000 + "x" + "</div>" * 5000 + "</article>"
    assert len(rows(deep)) == 5000


def test_page_of_another_template_gets_its_own_wrapper():
    seen = [f'<body><div class="post"><p>Text {k} of the post</p></div><div class="box">Fixed</div></body>' for k in range(4)]
    other = f'<body><div class="entry"><p>{"Long text of an entry. " * 9}</p></div><div class="post"><p>Teaser</p></div></body>'
    assert "Long text of an entry." in text(other, seen)
    assert text(seen[0], seen) == "Text 0 of the post"


def test_wrappers_come_from_all_pages(pages):
    """On 30 hosts, two of 14 pages have one more container; it is in every wrapper, however pages are dealt."""
    import json

    html = lambda k: f'<body><div class="post"><p>Text {k} of it</p></div>{"<div class=box><p>Box</p></div>" if k % 14 < 2 else ""}</body>'
    df = pages([(k, f"http://h{k // 14}.b/", html(k)) for k in range(420)])
    one, many = ({r["host"]: r for r in extract.host_wrappers(d).collect()} for d in (df.coalesce(1), df.repartition(7, "page_id")))
    assert one == many and len(one) == 30
    assert all(" > body > div class=box" in json.loads(r["paths"]) and r["root"] == "div class=post" for r in one.values())


def test_many_structures_are_aligned_in_groups(pages, monkeypatch):
    import json

    def html(k):
        return "<body><div class=post>" + "".join(f"<{t}>{t} {k} {i}</{t}>" for i, t in enumerate(["p", "h2", "pre"][int(c)] for c in format(k, "b").replace("1", "2"))) + f"</div><div class=top>Same</div><div id=x{k}>own {k}</div></body>"

    df = pages([(k, "http://a.b/", html(k)) for k in range(60)])
    whole = extract.host_wrappers(df).collect()
    monkeypatch.setattr(extract, "ALIGNED", 4)
    grouped = extract.host_wrappers(df.repartition(5, "page_id")).collect()
    assert [r["root"] for r in whole + grouped] == ["div class=post"] * 2
    assert json.loads(whole[0]["paths"]) == json.loads(grouped[0]["paths"]) == {"": False, " > body": False, " > body > div class=post": True, " > body > div class=top": False}


def test_pages_of_two_kinds_have_a_wrapper_each(pages):
    rows = [(k, "http://a.b/", f"<body><div class=x>Same</div><div class=post><p>Text {k} of it</p></div></body>") for k in range(40)]
    rows += [(40, "http://a.b/", "<body><article id=a40><p>Other</p></article><div class=post>no</div></body>")]
    got = {r["page_id"]: r["text"] for r in extract.page_texts(pages(rows)).collect()}
    assert got == {k: f"Text {k} of it" for k in range(40)} | {40: "Other"}


def test_page_is_title_and_document(spark):
    """Every page of the small tables holds its title and one document, nothing else."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in extract.page_texts(pages).collect():
        number = int(re.search(r"//[^/]*/[a-z]*/(\d+)", r["url"])[1])
        assert r["n_chars"] == len(r["text"])
        assert "".join(r["text"].split("\n\n", 1)[1].split()) == "".join(docs[number].split())
