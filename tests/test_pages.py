import random

import pytest

from sparkloom.operators import facts as X, pages as P, scale


def bfs(edges, seeds, limit):
    seen, now, depth = {s: 0 for s in seeds}, set(seeds), 0
    while now and (limit is None or depth < limit):
        depth += 1
        now = {t for s, t in edges if s in now} - seen.keys()
        seen.update({t: depth for t in now})
    return seen


@pytest.mark.parametrize("limit,bound", [(None, 1 << 20), (2, 1 << 20), (None, -1)])
def test_reachable_pages(spark, monkeypatch, limit, bound):
    monkeypatch.setattr(P, "BROADCAST_BYTES", bound)
    monkeypatch.setattr(scale, "HOT_ROWS", 5)
    random.seed(4)
    # A third of all links start at one page, a third lead to one page.
    node = lambda: "n0" if random.random() < 0.33 else f"n{random.randint(1, 120)}"
    edges = [(node(), node()) for _ in range(150)]
    links = spark.createDataFrame(edges, "url string, target_url string")
    seeds = spark.createDataFrame([("n1",), ("n2",)], "url string")
    got = P.reachable_pages(links, seeds, limit).collect()
    assert {r.url: r.depth for r in got} == bfs(edges, ["n1", "n2"], limit) and len(got) == len({r.url for r in got})


def test_a_round_opens_the_buckets_of_its_targets_only(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameReader

    opened, parquet = [], DataFrameReader.parquet

    def noting(self, *paths, **options):
        df = parquet(self, *paths, **options)
        if "bucket={" in paths[0]:
            opened.append(len(df.inputFiles()))
        return df

    monkeypatch.setattr(DataFrameReader, "parquet", noting)
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(30)], "url string, target_url string")
    got = P.reachable_pages(links, spark.createDataFrame([("n0",)], "url string")).collect()
    assert {r.url: r.depth for r in got} == {f"n{i}": i for i in range(31)}
    assert max(opened, default=0) <= 4 and sum(opened) < 31


@pytest.mark.parametrize("seeds", [[], [(None,)], [("nowhere",), ("nowhere",)]])
def test_walk_from_odd_seeds(spark, seeds):
    links = spark.createDataFrame([("a", "b"), (None, "c"), ("a", None)], "url string, target_url string")
    got = P.reachable_pages(links, spark.createDataFrame(seeds, "url string")).collect()
    assert sorted((r.url, r.depth) for r in got) == sorted({(*s, 0) for s in seeds})


def test_frontier_leaves_out_known_pages_and_details(spark):
    base = "https://x.test"
    pages = spark.createDataFrame([(1, f"{base}/animals/", ""), (2, f"{base}/animals/cat/", "")], "page_id int, url string, html string")
    links = spark.createDataFrame(
        [
            (1, f"{base}/animals/", 0, f"{base}/animals/dog/"),
            (1, f"{base}/animals/", 1, f"{base}/animals/cat"),
            (1, f"{base}/animals/", 2, f"{base}/about/"),
            (1, f"{base}/animals/", 3, f"{base}/animals/seen/"),
            (2, f"{base}/animals/cat/", 0, f"{base}/animals/deep/"),
            (3, f"{base}/", 5, f"{base}/animals/dog/"),
        ],
        "page_id int, url string, pos int, target_url string",
    )
    visited = spark.createDataFrame([(f"{base}/animals/seen/",)], "url string")
    got = P.next_frontier(pages, links, visited).collect()
    assert [tuple(r) for r in got] == [(1, 0, f"{base}/animals/dog/")]


def test_report_of_nothing(spark):
    from pyspark.sql import functions as F

    empty = spark.createDataFrame([], "response_time double, page_size_compressed bigint, page_size_uncompressed bigint")
    assert tuple(P.crawl_report(empty, F.lit(0.0), F.lit(3)).first()) == (0, 3, 0.0, 0.0, 0, 0)


def test_facts_of_odd_pages(spark):
    html = (
        '<div id="title-header"><h1>Cat &amp; Co</h1></div><h1>x</h1>'
        "<dl><dt>Diet</dt><dd><b>tagged</b></dd><dt>Main Diet</dt><dd>mice &lt; rats</dd><dt>Alone</dt><p></p><dt>Weight</dt><dd> 5 kg </dd>"
        "<dt><a>Group</a></dt><dd>clowder</dd><dt>Group Size</dt><dd>9</dd><dt><a>Color</a></dt><dd>grey</dd>"
        "<dt>Other Name(s)</dt><dd>Kitty, KITTY/Puss and cat & co|Sandy;Tom</dd></dl>"
        '<h2>Conservation Status</h2><ul><li><a href="x">Near Threatened</a></li></ul>'
        '<div class="c" id="single-animal-text"><h2>A <i>b</i></h2><p>one</p><p> </p><p>two\n three</p></div> </div></div>'
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>nothing</p>")], "page_id int, html string")
    cat, none, bare = sorted(X.extract_facts(pages).collect(), key=lambda r: r.page_id)
    assert cat.common_name == "Cat & Co" and cat.biological_facts.diet == "mice < rats" and cat.physical_characteristics.weight == "5 kg"
    assert cat.common_name_alternative == ["Cat & Co", "Kitty", "Puss", "Sandy", "Tom"]
    assert cat.group_name == "clowder" and cat.physical_color == ["grey"] and cat.taxonomy is None and cat.locations_range is None
    assert cat.conservation.conservation_status == "NT" and cat.descriptions == {"A b": "one two three"}
    for r in (none, bare):
        assert r.common_name is None and r.descriptions is None and r.conservation is None and r.meta is None
    assert [r.common_name for r in X.facts_dataset(X.extract_facts(pages)).collect()] == ["Cat & Co"]
