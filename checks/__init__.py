"""Registered queries and their DuckDB counterparts, one module per area."""

from checks import fact_queries, index_queries, match_queries, page_queries, search_queries, wiki_queries

AREAS = (index_queries, search_queries, page_queries, fact_queries, wiki_queries, match_queries)
