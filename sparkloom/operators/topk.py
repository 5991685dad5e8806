"""Best documents of many queries without scoring all that match: upper bounds per term and group of documents."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.operators.scale import cut_lineage, hinted, settle, top_k

# Groups of documents per doubling of their mass.
_STEPS = 2
# How many times k documents are scored first, by each of two choices, and the postings of the most frequent term used for it.
_FIRST, _RARE = 8, 64
# Up to this many (query, document, term) rows all matches are scored: that is one job, bounds take several.
DIRECT_HITS = 100_000_000
# Scores are compared after rounding to six digits; sums may also differ in their last bits.
_MARGIN = 2e-6


def placed(postings: DataFrame, impact: Column) -> DataFrame:
    """``postings (doc_id, field, term, ...)`` of query terms with ``impact``, ``_block``, ``_mass`` and ``_share``, stored.

    ``_mass`` is the sum of a document's impacts, ``_block`` the group of documents of nearly that mass, ``_share`` one divided
    by the document's rows, so that shares add up to documents.
    """
    of_doc = Window.partitionBy("doc_id")
    rows = postings.withColumn("impact", impact.cast("double"))
    rows = rows.withColumns({"_mass": F.sum("impact").over(of_doc), "_share": 1 / F.count("*").over(of_doc)})
    return cut_lineage(rows.withColumn("_block", F.floor(_STEPS * F.log2("_mass")).cast("int")))


def bounds(rows: DataFrame, weighted: DataFrame) -> DataFrame:
    """Rows ``(query, _block, field, term, weight, n, up, most, docs)``: what a term can add to a score in a block at most.

    ``up`` is the block's largest impact of the term times its weight, ``n`` its postings there; ``most`` is the largest mass
    of a document of the block, ``docs`` their number.
    """
    tops = rows.groupBy("_block", "field", "term").agg(F.max("impact").alias("top"), F.count("*").alias("n"))
    blocks = rows.groupBy("_block").agg(F.max("_mass").alias("most"), F.sum("_share").alias("docs"))
    weight = F.greatest("weight", F.lit(0.0))
    met = tops.join(F.broadcast(weighted.select("query", "field", "term", weight.alias("weight"))), ["field", "term"])
    return met.join(F.broadcast(blocks), "_block").withColumn("up", F.col("top") * F.col("weight")).drop("top")


def _first(limits: DataFrame, k: int) -> DataFrame:
    """Rows of ``limits`` to score first: the query's blocks of largest bound, and its terms of largest weight, until they have enough documents."""
    whole = limits.groupBy("query", "_block").agg(F.least(F.sum("up"), F.max("most") * F.max("weight")).alias("bound"), F.max("docs").alias("docs"))
    falling = Window.partitionBy("query").orderBy(F.desc("bound"), "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = whole.withColumn("ahead", F.coalesce(F.sum("docs").over(falling), F.lit(0.0))).filter(F.col("ahead") < _FIRST * k)
    by_term = limits.groupBy("query", "field", "term").agg(F.max("weight").alias("weight"), F.sum("n").alias("n")).filter(F.col("n") <= _RARE * k)
    rarest = Window.partitionBy("query").orderBy(F.desc("weight"), "field", "term").rowsBetween(Window.unboundedPreceding, -1)
    terms = by_term.withColumn("ahead", F.coalesce(F.sum("n").over(rarest), F.lit(0))).filter(F.col("ahead") < _FIRST * k)
    chosen = limits.join(blocks.select("query", "_block"), ["query", "_block"], "left_semi")
    return chosen.unionByName(limits.join(terms.select("query", "field", "term"), ["query", "field", "term"], "left_semi"))


def _essential(limits: DataFrame, reached: DataFrame, small: bool) -> DataFrame:
    """Rows of ``limits`` without terms that even together, and alone in a document of the block, cannot reach the query's score.

    From the smallest bound upwards, what such terms add is at most the sum of their bounds, and at most the block's largest
    mass times their largest weight.
    """
    rising = Window.partitionBy("query", "_block").orderBy("up", "field", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    together = F.least(F.sum("up").over(rising), F.col("most") * F.max("weight").over(rising))
    enough = F.col("together") * (1 + 1e-9) + _MARGIN >= F.col("reached")
    known = limits.withColumn("together", together).join(hinted(reached, small), "query", "left")
    return known.filter(F.col("reached").isNull() | enough)


def _covers(limits: DataFrame) -> DataFrame:
    """Rows ``(_block, field, term, queries)``: documents of the block with the term may matter for these queries."""
    return limits.groupBy("_block", "field", "term").agg(F.collect_set("query").alias("queries"))


def candidates(rows: DataFrame, covers: DataFrame, small: bool) -> DataFrame:
    """``rows`` (together by document) of documents that matter for some query, with these queries as ``_may``."""
    met = rows.join(hinted(covers, small), ["_block", "field", "term"]).select("doc_id", F.explode("queries").alias("query"))
    may = met.groupBy("doc_id").agg(F.collect_set("query").alias("_may"))
    return rows.join(may, "doc_id")


def pruned(rows: DataFrame, weighted: DataFrame, scores: Callable[[DataFrame], DataFrame], k: int, needed: DataFrame | None = None) -> DataFrame:
    """Rows ``(query, doc_id, score)`` with all that can be among the best ``k`` of a query, and few others.

    ``rows`` come from ``placed``; ``weighted (query, field, term, weight)`` numbers the queries and is small enough to be
    broadcast. ``scores(hits)`` scores hits, which are rows of ``rows`` and ``weighted`` joined.

    1. Every block of documents gets an upper bound per query term.
    2. Documents of the best blocks and of the rarest terms are scored. The k-th score found is reached whatever the rest holds.
    3. Terms that cannot reach it together are not essential: a document that has no other term of the query is
       not scored. A query with fewer than ``k`` matches so far keeps all of its terms.

    ``needed (query, field, term)`` names, for some queries, terms of which each match has at least one; other documents
    are not scored for these queries.
    """
    limits = cut_lineage(bounds(rows, weighted))
    by_doc = rows.repartition("doc_id")

    def scored(chosen: DataFrame) -> DataFrame:
        if needed is not None:
            # Blocks in which some term is left, there by the needed terms.
            of = needed.select("query").distinct()
            open_blocks = chosen.join(F.broadcast(of), "query", "left_semi").select("query", "_block").distinct()
            by_need = open_blocks.join(F.broadcast(needed), "query").select("query", "_block", "field", "term")
            chosen = chosen.join(F.broadcast(of), "query", "left_anti").select("query", "_block", "field", "term").unionByName(by_need)
        met = candidates(by_doc, *settle(_covers(chosen)))
        hits = met.join(F.broadcast(weighted), ["field", "term"]).filter(F.array_contains("_may", F.col("query")))
        return scores(hits)

    best = top_k(scored(_first(limits, k)), ["query"], [F.desc("score"), F.asc("doc_id")], k, ["doc_id"])
    reached = best.groupBy("query").agg(F.min("score").alias("reached"), F.count("*").alias("n")).filter(F.col("n") >= k)
    return scored(_essential(limits, *settle(reached.select("query", "reached"))))


def numbered(ids: DataFrame) -> DataFrame:
    """``ids (query_id)`` with a number ``query``, stored; there are few enough to be broadcast."""
    return cut_lineage(ids.distinct().withColumn("query", F.row_number().over(Window.orderBy("query_id"))))
