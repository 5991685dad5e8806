import pytest

import __spark_entry__ as entry
from checks import AREAS
from checks.compare import compare, connect
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    for area in AREAS:
        assert area.QUERIES.keys() == area.ORACLES.keys()


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["index_idf", "search_mixed", "rank_tfidf", "bm25_multi_field", "page_links", "facts_record", "wiki_records", "match_shared_names", "merged_union"]
)
def test_results_equal_sql(spark, con, name):
    assert compare(spark, con, SMALL, entry.queries()[name], entry.oracle_sql()[name]) == ""
