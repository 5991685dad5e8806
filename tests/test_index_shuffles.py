"""An index of all terms: how often its postings are shuffled, and that its rows and their order stay right."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import index_queries, search_queries
from sparkloom.operators import index as I

WORDS = [f"w{i}" for i in range(30)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(n, ids):
    random.seed(3)
    return [(ids(i), " ".join(random.choice(WORDS) if random.random() > 0.3 else "hot" for _ in range(random.randint(0, 12)))) for i in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """One file of documents with ids that repeat or are missing."""
    path = str(tmp_path_factory.mktemp("texts"))
    rows = [(*r, "en" if i % 3 else None) for i, r in enumerate(rows_of(400, lambda i: None if i % 40 == 0 else i % 350))]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(I, "TASK_TEXTS", 50)


def counted(rows):
    return Counter(("", w, d) for d, t in rows for w in t.split())


def test_sorted_index_shuffles_postings_once(spark, folder, small_tasks):
    text = plan(index_queries.index_sorted(spark, folder))
    assert len(re.findall(r"Exchange rangepartitioning", text)) == 1
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("hot_rows", [5, 20_000], ids=["frequent", "rare"])
@pytest.mark.parametrize("fields", [("",), ("", "f")], ids=["one", "two"])
def test_sorted_index_counts_and_orders(spark, monkeypatch, hot_rows, fields):
    monkeypatch.setattr(I, "HOT_ROWS", hot_rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        token_rows = [(f, w, d) for f in fields for d, t in rows_of(300, lambda i: None if i % 50 == 0 else i % 280) for w in t.split()]
        index = I.build_index(spark.createDataFrame(token_rows, "field string, term string, doc_id bigint"), F.lit(300))
        got = I.sorted_index(index).select("field", "term", "doc_id", "tf", "df", F.round("idf_standard", 6), F.round("idf_smooth", 6)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tf = Counter(token_rows)
    df = Counter(key[:2] for key in tf)
    stats = {(r["field"], r["term"]): tuple(r)[2:] for r in index.terms.select("field", "term", "df", F.round("idf_standard", 6), F.round("idf_smooth", 6)).collect()}
    order = sorted(tf, key=lambda k: (k[0], k[1], k[2] is not None, k[2] or 0))
    assert [tuple(r) for r in got] == [(*k, tf[k], *stats[k[:2]]) for k in order]
    assert all(r["df"] == df[r["field"], r["term"]] for r in got)


def test_sorted_index_without_rows(spark):
    assert I.sorted_index(I.build_index(spark.createDataFrame([], "field string, term string, doc_id bigint"), F.lit(0))).count() == 0


def test_texts_meet_by_id_before_they_are_counted(spark, small_tasks):
    rows = rows_of(300, lambda i: None if i % 50 == 0 else i % 280)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = I.postings(I.text_tokens(I.by_document(docs)))
    assert re.findall(r"Exchange hashpartitioning\((\w+)[^,]*, (\d+)\)", plan(found)) == [("doc_id", "6")]
    assert {tuple(r)[:3]: r["tf"] for r in found.collect()} == counted(rows)


def test_rows_of_one_id_are_not_one_task(spark, small_tasks):
    rows = rows_of(300, lambda i: None if i % 2 else i)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert I.by_document(docs) is docs
    assert {tuple(r)[:3]: r["tf"] for r in I.postings(I.text_tokens(I.by_document(docs))).collect()} == counted(rows)
    assert I.by_document(docs.limit(0)).count() == 0


def test_stored_postings_are_shuffled_by_bucket_alone(spark, folder, small_tasks, monkeypatch):
    plans, write = [], I.write_index
    monkeypatch.setattr(I, "write_index", lambda postings, *a, **kw: plans.append(plan(postings)) or write(postings, *a, **kw))
    search_queries.stored_index_mixed_buckets(spark, folder)
    index_queries.stored_index(spark, folder)
    assert len(plans) == 3 and all(re.findall(r"Exchange hashpartitioning\((\w+)", p) == ["doc_id"] for p in plans)


def test_batches_are_named_by_their_folder(spark, tmp_path, monkeypatch):
    """The rows that are shuffled and sorted do not carry the name of the batch."""
    frame, seen = type(spark.range(0)), []
    kept = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, *a: seen.append(self.columns) or kept(self, *a))
    path = str(tmp_path)
    for mode, n in (("overwrite", 3), ("append", 2)):
        rows = rows_of(60, lambda i, n=n: i * 10 + n)
        I.write_index(I.postings(I.text_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"))), 60, path, mode, n)
        expected = counted(rows) if mode == "overwrite" else expected + counted(rows)
    assert seen and all("batch" not in c for c in seen)
    assert {tuple(r)[:3]: r["tf"] for r in I.read_index(spark, path).postings.select("field", "term", "doc_id", "tf").collect()} == expected
