import pytest
from pyspark.sql import functions as F

from sparkloom.operators import index as I, search as S
from sparkloom.plans import jobs
from sparkloom.sources import readers, writers

DUMP = """<mediawiki{ns}>
<siteinfo><sitename>x</sitename></siteinfo>
<page><title>Lion &amp; cub</title><ns>0</ns><id>12</id><revision><id>99</id><text bytes="5" xml:space="preserve">{{{{Speciesbox
| genus = Panthera &lt;!-- c --&gt;
| species = leo
}}}}
The ''lion'' &amp;amp; cub.
== Range ==
[[Category:Cats]]</text></revision></page>
<page><title>Other</title><id>13</id><revision><id>98</id><text>no box</text></revision></page>
<page><title>NoText</title><id>6</id></page>
<page><id>5</id><revision><id>78</id><text>no title</text></revision></page>
<page><id>7</id><revision><id>80</id><timestamp>2024-05-06T07:08:09Z</timestamp><contributor><username>U</username><id>3</id></contributor><text>{{{{speciesbox}}}} untitled</text></revision><revision><id>79</id><text>older</text></revision></page>
</mediawiki>"""


@pytest.fixture
def dump(tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    (folder / "chunk_2.xml").write_text(DUMP.format(ns=""))
    (folder / "chunk_10.xml").write_text(DUMP.format(ns=' xmlns="http://example.test/export/"'))
    (folder / "notes.txt").write_text("not xml")
    return str(folder)


def test_dump_to_records(spark, dump, tmp_path):
    report = {r.chunk: (r.total_pages, r.matched_pages) for r in jobs.filter_dump(spark, f"{dump}/*.xml", str(tmp_path / "f")).collect()}
    assert report == {"chunk_2.xml": (5, 2), "chunk_10.xml": (5, 2), None: (10, 4)}
    chunks = readers.read_filtered_chunks(spark, str(tmp_path / "f/pages"))
    assert sorted((r.chunk_no, r.title or "") for r in chunks.collect()) == [(2, ""), (2, "Lion & cub"), (10, ""), (10, "Lion & cub")]
    assert tuple(writers.merge_summary(chunks).first()) == (4, 2)
    writers.write_merged_chunks(chunks, str(tmp_path / "m"))
    merged = readers.read_dump_pages(spark, str(tmp_path / "m"))
    assert merged.count() == 4
    whole = merged.filter("wiki_id = 7").first()
    assert whole.text == "{{speciesbox}} untitled" and whole.title is None
    assert [(r.id, r.timestamp, r.contributor and r.contributor.username, r.text["_VALUE"]) for r in whole.page.revision] == [
        (80, "2024-05-06T07:08:09Z", "U", "{{speciesbox}} untitled"), (79, None, None, "older"),
    ]
    lion_page = merged.filter("wiki_id = 12").first().page
    assert (lion_page.ns, lion_page.revision[0].id, lion_page.revision[0].text["_bytes"]) == (0, 99, 5)

    records = {r.animal_name: r for r in jobs.extract_dump(spark, f"{dump}/*.xml", str(tmp_path / "r")).collect()}
    assert records.keys() == {"Lion & cub", "Other", "NoText"}
    lion = records["Lion & cub"]
    assert (lion.wiki_id, lion.genus, lion.species, lion.status) == (12, "Panthera", "leo", None)
    assert lion.scientific_names == ["Panthera leo"] and lion.text_sections == ["Range"] and lion.categories == ["Cats"]
    assert lion.abstract == "The ''lion'' &amp; cub." and records["Other"].scientific_names is None

    left = spark.createDataFrame([("lion", "Lion (cub)", ["Lion cub"], None), ("x", "Nothing", None, None)], "key string, common_name string, common_name_alternative array<string>, scientific_name string")
    right = spark.read.parquet(str(tmp_path / "r")).withColumn("wiki_key", F.col("animal_name"))
    out = jobs.match_and_merge(left, right, str(tmp_path / "merged"))
    rows = {r.key: r for r in out.records.collect()}
    assert rows["lion"].match_type == 1 and rows["lion"].meta.wiki_id == 12 and rows["lion"].abstract == "The lion & cub. Range"
    assert rows["x"].match_type is None and rows["Other"].origin == "right_only" and len(rows) == 4
    stats = out.stats.first()
    assert (stats.total_records, stats.matched_records, stats.right_only_records, stats.match_rate) == (2, 1, 2, 0.5)


def test_pages_to_facts(spark, tmp_path):
    for name, h1 in (("a.html", "Cat"), ("b.html", "Cat"), ("c.html", ""), ("d.htm", "Dog")):
        (tmp_path / name).write_text(f'<div id="title-header"><h1>{h1}</h1></div>')
    rows = jobs.extract_pages(spark, str(tmp_path), str(tmp_path / "out")).collect()
    assert [(r.common_name, r.meta.source_file) for r in rows] == [("Cat", "b.html")]


def test_json_to_search(spark, tmp_path):
    (tmp_path / "records.json").write_text('/* c */ {"Red fox": {"diet": {"main": "mice"}, "tags": ["small", "red"]}, // x\n "Bear": "honey"}')
    records = readers.read_keyed_json(spark, str(tmp_path / "records.json"))
    assert records.first().source.endswith("/records.json")
    broken = spark.createDataFrame([("Broken", "{oops")], "name string, record string")
    rows = records.unionByName(broken, allowMissingColumns=True)
    index = jobs.create_search_index(rows, str(tmp_path / "index"), buckets=4)
    jobs.create_search_index(spark.createDataFrame([("Fox", '{"diet": "red mice"}')], "name string, record string"), str(tmp_path / "index"), "append", 4)
    from sparkloom.operators import field_search as B

    index = B.read_field_index(spark, str(tmp_path / "index"))
    queries = spark.createDataFrame([("any", "red", None), ("path", "mice", "diet.main"), ("exact", "Red fox", "exact_name")], "query_id string, text string, field string")
    contents = jobs.indexed_documents(spark, str(tmp_path / "index"))
    assert {r.doc_id: (r.content, r.source is None) for r in contents.collect()} == {
        "Red fox": ("mice\nsmall\nred", False), "Bear": ("honey", False), "Fox": ("red mice", True),
    }
    got = {(r.query_id, r["rank"]): (r.doc_id, r.snippet) for r in jobs.search_results(index, queries, contents).collect()}
    assert got[("path", 1)] == ("Red fox", "mice small red") and got[("exact", 1)][0] == "Red fox"
    assert {d for (q, _), (d, _) in got.items() if q == "any"} == {"Red fox", "Fox"}
    assert [r.name for r in jobs.rejected_records(spark, str(tmp_path / "index")).collect()] == ["Broken"]
    (tmp_path / "list.json").write_text("[1]")
    with pytest.raises(Exception, match="not a JSON object"):
        readers.read_keyed_json(spark, str(tmp_path / "list.json")).collect()


def test_record_index_is_pruned_by_bucket(spark, tmp_path):
    docs = spark.createDataFrame([(1, "fur", "white bear"), (2, "scales", "white snake")], "doc_id bigint, skin_type string, text string")
    index = jobs.index_records(docs, str(tmp_path / "i"), buckets=8)
    queries = S.query_table(spark, {"q": S.term("white") & S.field("skin type", "fur")})
    found = S.boolean_search(index, queries)
    assert [tuple(r) for r in found.collect()] == [("q", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "bucket" in line]
    assert len(scans) >= 2 and all("bucket#" in s.split("PartitionFilters:")[1].split("PushedFilters")[0] for s in scans)
    assert all("In(term" in s for s in scans)


def test_batches_with_their_own_buckets(spark, tmp_path):
    rows = [(i, f"alpha beta{i % 7} w{i}") for i in range(120)]
    whole = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = str(tmp_path / "i")
    jobs.index_texts(whole.filter("doc_id < 60"), path, buckets=8)
    index = jobs.index_texts(whole.filter("doc_id >= 60"), path, "append")
    queries = S.query_table(spark, {q: S.term(q) for q in ("alpha", "beta1", "w5", "w77")})
    got = S.boolean_search(index, queries).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {"alpha": 120, "beta1": 17, "w5": 1, "w77": 1}
    terms = {r.term: r.df for r in index.terms.collect()}
    assert terms["alpha"] == 120 and terms["beta1"] == 17


def test_half_written_batches_do_not_count(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"alpha w{i}") for i in range(20)], "doc_id bigint, text string")
    path = str(tmp_path / "i")
    jobs.index_texts(docs.filter("doc_id < 10"), path, buckets=4)
    more = docs.filter("doc_id >= 10")
    with monkeypatch.context() as m:
        m.setattr(I, "_ddl", lambda df: 1 / 0)  # dies after postings, counts and sizes, before the commit
        with pytest.raises(ZeroDivisionError):
            jobs.index_texts(more, path, "append", 4)
    index = I.read_index(spark, path)
    assert (index.postings.count(), index.terms.filter("term = 'alpha'").first().df) == (20, 10)
    index = jobs.index_texts(more, path, "append", 4)
    assert (index.postings.count(), index.terms.filter("term = 'alpha'").first().df) == (40, 20)
    index = jobs.index_texts(docs.limit(0), path, "overwrite", 4)
    assert index.postings.count() == index.terms.count() == 0
    with pytest.raises(ValueError, match="no committed index"):
        I.read_index(spark, str(tmp_path / "none"))


def test_a_repeated_append_shows_documents_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "i")
    rows = spark.createDataFrame([("Dog", '{"diet": "meat"}'), ("Bad", "{")], "name string, record string")
    jobs.create_search_index(spark.createDataFrame([("Fox", '{"diet": "mice"}')], "name string, record string"), path, buckets=4)
    with monkeypatch.context() as m:
        m.setattr(I, "_ddl", lambda df: 1 / 0)  # dies after all tables are written, before the commit
        with pytest.raises(ZeroDivisionError):
            jobs.create_search_index(rows, path, "append", 4)
    assert [r.doc_id for r in jobs.indexed_documents(spark, path).collect()] == ["Fox"] and jobs.rejected_records(spark, path).count() == 0
    index = jobs.create_search_index(rows, path, "append", 4)
    queries = spark.createDataFrame([("q", "meat"), ("none", None)], "query_id string, text string")
    found = jobs.search_results(index, queries, jobs.indexed_documents(spark, path))
    assert [(r.query_id, r["rank"], r.doc_id) for r in found.collect()] == [("q", 1, "Dog")]
    assert [r.name for r in jobs.rejected_records(spark, path).collect()] == ["Bad"]
    jobs.create_search_index(rows.limit(0), path, "overwrite", 4)
    assert jobs.indexed_documents(spark, path).count() == 0


def test_url_sets_and_metadata(spark, tmp_path):
    urls = spark.createDataFrame([("b ",), ("a",), ("",), ("a",)], "url string")
    for _ in range(2):
        writers.append_url_set(urls, str(tmp_path / "u"))
    assert sorted(r.url for r in readers.read_url_set(spark, str(tmp_path / "u")).collect()) == ["a", "b"]
    meta = spark.createDataFrame([("u", 'say "hi", x', 200)], "url string, title string, status_code int")
    for _ in range(2):
        writers.write_metadata_csv(meta, str(tmp_path / "m"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "m"))
    assert back.columns[:2] == ["URL", "HTTP Status Code"] and back.count() == 2
    assert back.first()["HTML Title"] == 'say "hi", x' and back.first()["robots Directive"] is None
