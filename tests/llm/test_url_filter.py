import pytest

from sparkloom.llm import url_filter as u


@pytest.fixture(scope="module")
def urls(spark):
    def make(rows):
        return spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string").selectExpr("*", "1 as host", "2 as block", "3 as listed", "4 as _hit")

    return make


def test_rules(urls):
    want = {
        "http://example.com/en/1": ("example.com/en/", "block"), "https://www.EXAMPLE.com/en/": ("www.example.com/en/", "allow"), "http://m.example.com/en/x": ("example.com/en/", "block"),
        "http://example.com/de": ("com/", "allow"), "http://example.com": (None, "allow"), "http://com/": ("com/", "allow"), "http://notcom/": (None, "allow"), "http://a.net/es/": ("net/es/", "block"),
        "http://a.net/es": (None, "allow"), "http://a.net/en/fr/": (None, "allow"), "no scheme": (None, "allow"), "": (None, "allow"), None: (None, "allow"), "a://b.net?/fr/": (None, "allow"),
    }
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in u.judge_urls(urls(list(want)), urls([])).collect()}
    assert [got[k] for k in range(len(want))] == list(want.values())


def test_listed_urls_are_found_whatever_their_form(urls):
    listed = ["http://www.spam.org/a/", "https://x.org/p?utm_source=f&id=3", "nothing"]
    tried = ["https://spam.org/a#top", "http://spam.org/a?ref=x", "http://spam.org/b", "http://x.org/p?id=3", "http://x.org/p", "nothing", None]
    got = {r["page_id"]: r["verdict"] for r in u.judge_urls(urls(tried), urls(listed)).collect()}
    assert [got[k] for k in range(len(tried))] == ["block", "block", "allow", "block", "allow", "allow", "allow"]


@pytest.mark.parametrize("most", [1, 4, 1 << 17])
def test_false_positives_do_not_block(urls, monkeypatch, most):
    monkeypatch.setattr(u, "_MOST_BLOCKS", most)
    listed = [f"http://l{k}.org/{k}" for k in range(0, 3000, 3)]
    tried = [f"https://l{k}.org/{k}/" for k in range(3000)] + ["http://l0.org/0"] * 50
    got = {(r["page_id"], r["verdict"]) for r in u.judge_urls(urls(tried), urls(listed)).collect()}
    assert got == {(k, "block" if k % 3 == 0 or k >= 3000 else "allow") for k in range(3050)}


def test_filter_passes_all_listed_and_few_others(urls):
    from pyspark.sql import functions as F

    listed = urls([f"http://l{k}.org/" for k in range(1000)]).select(u.canonical(F.col("url")).alias("listed"))
    bits = u.bloom_filter(listed, 32)
    for prefix, low, high in (("l", 1000, 1000), ("m", 0, 60)):
        asked = urls([f"http://{prefix}{k}.org/" for k in range(1000)]).select(u.canonical(F.col("url")).alias("key"))
        joined = asked.join(bits, u._block(F.col("key"), 32) == F.col("block"))
        for k, m in enumerate(u._masks(F.col("key"))):
            joined = joined.filter(F.col(f"word{k}").bitwiseAND(m) == m)
        assert low <= joined.count() <= high


def test_empty_tables(urls):
    assert u.judge_urls(urls(["http://a.org/"]).limit(0), urls(["http://a.org/"])).count() == 0
