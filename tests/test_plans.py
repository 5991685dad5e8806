"""The plans that matter at scale: what is pushed down, shuffled, broadcast, and never done."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["index_idf", "rank_tfidf", "bm25_multi_field", "page_links", "next_frontier", "skip_reasons", "facts_record", "wiki_records", "match_entities", "merge_records"],
)
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", ["unescape_html", "finished_records", "merged_union"])
def test_no_python_for_entities(spark, name):
    assert not re.search("EvalPython|InPandas|InArrow", plan(QUERIES[name](spark, SMALL)))


@pytest.mark.parametrize("name,column,most", [("match_stats", "origin", 1), ("match_entities", "c_custkey", 2), ("bm25_content", "conv_id", 1), ("batch_topk", "text", 1)])
def test_inputs_are_read_once(spark, name, column, most):
    """In the plan that ran, where Spark has reused equal exchanges. Both sides of ``match_entities`` come from one table, each reads it once."""
    df = QUERIES[name](spark, SMALL)
    df.collect()
    final = plan(df).split("+- == Initial Plan ==")[0]
    found = [line for line in final.split("\n") if "FileScan" in line and re.search(rf"[<,]{column}:", line.split("ReadSchema:")[1])]
    assert len(found) <= most, found


@pytest.mark.parametrize("name,columns", [("page_links", "page_id:bigint,url:string,html:string"), ("index_postings", "doc_id:bigint,text:string"), ("snippet", "doc_id:bigint,text:string")])
def test_scans_read_only_what_is_needed(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(QUERIES[name](spark, SMALL))


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


@pytest.mark.parametrize("name", ["page_links", "page_metadata", "facts_record", "wiki_records", "clean_wikitext", "json_leaves", "field_documents", "tokenize"])
def test_extraction_stays_inside_the_row(spark, name):
    assert not exchanges(plan(QUERIES[name](spark, SMALL)))


def test_top_k_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["rank_tfidf"](spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_scores_of_a_document_are_added_without_a_shuffle_of_their_own(spark):
    text = plan(QUERIES["batch_topk"](spark, SMALL))
    assert not any(re.match(r"query_id#\d+, doc_id", e) for e in exchanges(text))
    assert any(re.match(r"doc_id#\d+L?, \d+", e) for e in exchanges(text))


def test_postings_are_counted_before_the_shuffle(spark):
    text = plan(QUERIES["index_postings"](spark, SMALL))
    assert text.count("partial_count") == 1 and len(exchanges(text)) == 1


def test_duplicates_are_cut_before_the_shuffle(spark):
    assert re.search(r"WindowGroupLimit .*Partial", plan(QUERIES["wiki_dedupe"](spark, SMALL)))
