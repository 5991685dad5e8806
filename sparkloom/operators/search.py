"""Boolean search ranked by TF-IDF, for many queries at once.

Queries are built from ``term``, ``field``, ``&`` and ``|`` (or ``all_of``, ``any_of``)::

    query_table(spark, {"q": term("white") & (term("mammal") | field("skin_type", "fur"))})

and become rows ``(query_id, expr)`` with ``expr`` in operands-first order.
"""

from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkloom.functions.columns import first_of
from sparkloom.functions.text import first_term, format_key
from sparkloom.operators.index import Index, build_index
from sparkloom.operators.scale import cut_lineage, hinted, lookup_join, settle, top_k
from sparkloom.operators.topk import DIRECT_HITS, numbered, placed, pruned

_AND, _OR = "&", "||"
_BITS = 62


class Expr(NamedTuple):
    """Part of a query, as operands and operators in evaluation order."""

    steps: tuple[str, ...]

    def __and__(self, other: "Expr") -> "Expr":
        return Expr(self.steps + other.steps + (_AND,))

    def __or__(self, other: "Expr") -> "Expr":
        return Expr(self.steps + other.steps + (_OR,))

    def then(self, other: "Expr") -> "Expr":
        """Put terms side by side without an operator: both rank, only the first one selects."""
        return Expr(self.steps + other.steps)


def term(text: str) -> Expr:
    return Expr((text,))


def field(name: str, value: str) -> Expr:
    return Expr((f"{name}:{value}",))


def all_of(*parts: Expr) -> Expr:
    return reduce(Expr.__and__, parts)


def any_of(*parts: Expr) -> Expr:
    return reduce(Expr.__or__, parts)


def query_table(spark: SparkSession, exprs: Mapping[str, Expr]) -> DataFrame:
    rows = [(name, list(e.steps)) for name, e in exprs.items()]
    return spark.createDataFrame(rows, "query_id string, expr array<string>")


def _normal_step(step: Column) -> Column:
    """Struct ``(field, term)``; operators have no field, unusable terms have no term.

    Only the first token of a term counts. A step such as ``name:`` is a plain term.
    """
    name, value = F.substring_index(step, ":", 1), F.regexp_extract(step, r"(?s)^[^:]*:(.*)$", 1)
    in_field = step.contains(":") & (name != "") & (value != "")
    return (
        F.when(step.isin(_AND, _OR), F.struct(F.lit(None).cast("string").alias("field"), step.alias("term")))
        .when(in_field, F.struct(format_key(name).alias("field"), first_term(value).alias("term")))
        .otherwise(F.struct(F.lit("").alias("field"), first_term(step).alias("term")))
    )


def prepare_queries(queries: DataFrame) -> DataFrame:
    """Rows ``(query_id, steps, terms, valid, shape)``: normal form of ``(query_id, expr)``.

    ``steps`` holds -1 for AND, -2 for OR and else an index into the distinct ``terms``.
    A query is invalid when an operator lacks an operand.
    """
    steps = F.filter(F.transform("expr", _normal_step), lambda s: s["term"].isNotNull())
    terms = F.array_distinct(F.filter("normal", lambda s: s["field"].isNotNull()))
    coded = F.transform(
        "normal",
        lambda s: F.when(s["field"].isNull(), F.when(s["term"] == _AND, -1).otherwise(-2)).otherwise(
            (F.array_position("terms", s) - 1).cast("int")
        ),
    )
    operands = F.aggregate(
        "steps",
        F.lit(0),
        lambda n, s: F.when(n < 0, n).when(s >= 0, n + 1).when(n < 2, F.lit(-1)).otherwise(n - 1),
    )
    return (
        queries.select("query_id", steps.alias("normal"))
        .withColumn("terms", terms)
        .withColumn("steps", coded)
        .select("query_id", "steps", "terms", (operands > 0).alias("valid"), _shape().alias("shape"))
    )


def _shape() -> Column:
    """``any`` or ``all`` for queries that take any or all of their terms, else ``mixed``.

    Two terms side by side make a query mixed.
    """
    operators = F.filter("steps", lambda s: s < 0)
    complete = F.size("steps") == 2 * F.size(operators) + 1
    return (
        F.when(complete & F.forall(operators, lambda s: s == -2), "any")
        .when(complete & F.forall(operators, lambda s: s == -1), "all")
        .otherwise("mixed")
    )


def query_terms(prepared: DataFrame) -> DataFrame:
    """One row per distinct term of a query, with the place of its bit."""
    rows = prepared.filter("valid").select("query_id", F.posexplode("terms").alias("at", "t"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("at", F.lit(_BITS)))
    word = F.floor(F.col("at") / _BITS).cast("int")
    return rows.select("query_id", "at", word.alias("word"), bit.alias("bit"), "t.field", "t.term")


def _holds(steps: Column, words: Column) -> Column:
    """Evaluate a query on the bits of the terms that a document has."""

    def combined(stack: Column, step: Column) -> Column:
        n = F.size(stack)
        left, right = F.get(stack, n - 2), F.get(stack, n - 1)
        both = F.when(step == -1, left & right).otherwise(left | right)
        return F.concat(F.slice(stack, F.lit(1), n - 2), F.array(both))

    def step_once(stack: Column, step: Column) -> Column:
        place = F.pmod(step, F.lit(_BITS))
        has = F.getbit(F.get(words, F.floor(step / _BITS).cast("int")), place) == 1
        return F.when(step < 0, combined(stack, step)).otherwise(F.concat(stack, F.array(has)))

    return first_of(F.aggregate(steps, F.array().cast("array<boolean>"), step_once))


class Prepared(NamedTuple):
    """Queries in normal form with their terms; ``small`` tells that the terms may be broadcast.

    ``plain`` and ``covered`` tell whether there are queries that any of their terms fulfils, and others.
    """

    table: DataFrame
    terms: DataFrame
    small: bool
    n_words: int
    n_terms: int
    plain: bool
    covered: bool


def prepare(queries: "DataFrame | Prepared") -> Prepared:
    """Prepare ``(query_id, expr)`` once for several uses."""
    if isinstance(queries, Prepared):
        return queries
    table, small = settle(prepare_queries(queries))
    n, is_any = F.size("terms"), F.col("shape") == "any"
    most, n_terms, n_any, n_other = table.agg(F.max(n), F.sum(n), F.count_if(is_any), F.count_if(~is_any)).first()
    return Prepared(table, query_terms(table), small, (most or 0) // _BITS + 1, n_terms or 0, n_any > 0, n_other > 0)


def index_for(token_rows: DataFrame, n_docs: Column, queries: "DataFrame | Prepared") -> Index:
    """Index of the query terms alone, for a search without a stored index.

    Other tokens are dropped inside the scan, so they are neither counted nor shuffled, and so are those of documents
    without an id. A join by document asks for an id too; saying so here keeps all uses of the postings equal, and Spark runs them once.
    """
    prepared = prepare(queries)
    wanted = hinted(prepared.terms.select("field", "term").distinct(), prepared.small)
    return build_index(token_rows.filter(F.col("doc_id").isNotNull()).join(wanted, ["field", "term"], "left_semi"), n_docs)


def necessary_terms(weighted: DataFrame, prepared: Prepared) -> DataFrame:
    """Rows ``(query_id, field, term)``: terms of which every match of a query has at least one, as rare as can be.

    Worked out along the query: a term needs itself, an AND what the cheaper side needs, an OR what both sides need; the
    cost is the number of postings. A term that the index does not know costs nothing: nothing can match it.
    """
    rules = prepared.table.filter(F.col("valid") & (F.col("shape") != "any"))
    known = weighted.join(F.broadcast(rules.select("query_id")), "query_id", "left_semi")
    known = known.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "df"))).alias("dfs"))
    empty = F.array().cast("array<struct<cost:bigint,terms:array<int>>>")

    def combined(stack: Column, step: Column) -> Column:
        n = F.size(stack)
        left, right = F.get(stack, n - 2), F.get(stack, n - 1)
        both = F.struct((left["cost"] + right["cost"]).alias("cost"), F.concat(left["terms"], right["terms"]).alias("terms"))
        cheaper = F.when(left["cost"] <= right["cost"], left).otherwise(right)
        return F.concat(F.slice(stack, F.lit(1), n - 2), F.array(F.when(step == -1, cheaper).otherwise(both)))

    def step_once(stack: Column, step: Column) -> Column:
        cost = F.coalesce(F.try_element_at("dfs", step), F.lit(0)).cast("bigint")
        own = F.struct(cost.alias("cost"), F.array(step).alias("terms"))
        return F.when(step < 0, combined(stack, step)).otherwise(F.concat(stack, F.array(own)))

    cover = first_of(F.aggregate("steps", empty, step_once))["terms"]
    named = rules.join(F.broadcast(known), "query_id", "left").select("query_id", F.explode(F.transform(cover, lambda at: F.get("terms", at))).alias("t"))
    return named.select("query_id", "t.field", "t.term").distinct()


def _hits(postings: DataFrame, weighted: DataFrame, prepared: Prepared) -> DataFrame:
    """Postings (together by document) joined with the queries that they may matter for.

    A query that any of its terms fulfils meets all postings of its terms. Another one meets a document only if that
    has one of its necessary terms; which queries a document may match is gathered from its own postings first, so a very
    frequent term beside a rare one makes no rows for documents that cannot match.
    """
    parts = []
    if prepared.plain or not prepared.covered:
        others = F.broadcast(prepared.table.filter(F.col("shape") != "any").select("query_id"))
        plain = weighted.join(others, "query_id", "left_anti") if prepared.covered else weighted
        parts.append(postings.join(F.broadcast(plain), ["field", "term"]))
    if prepared.covered:
        cover = F.broadcast(necessary_terms(weighted, prepared))
        # Naming the frequency keeps the rows as wide as those that are scored, so both come from one shuffle.
        queries = F.collect_set(F.when(F.col("tf") > 0, F.col("query_id")))
        may = postings.join(cover, ["field", "term"]).groupBy("doc_id").agg(queries.alias("_may"))
        others = weighted.join(F.broadcast(prepared.table.filter(F.col("shape") != "any").select("query_id")), "query_id", "left_semi")
        met = postings.join(may, "doc_id").join(F.broadcast(others), ["field", "term"])
        parts.append(met.filter(F.array_contains("_may", F.col("query_id"))).drop("_may"))
    return reduce(DataFrame.unionByName, parts)


def _matched(hits: DataFrame, prepared: Prepared, scores: list[Column]) -> DataFrame:
    """Rows ``(query_id, doc_id, ...)`` of the documents whose terms fulfil a query, with their scores.

    The terms that a document has are bits of as many numbers as the longest query needs.
    """
    words = [F.col(f"_w{w}") for w in range(prepared.n_words)]
    masks = [F.bit_or(F.when(F.col("word") == w, F.col("bit")).otherwise(0)).alias(f"_w{w}") for w in range(len(words))]
    found = hits.groupBy("query_id", "doc_id").agg(*scores, *masks)
    rules = prepared.table.filter("valid").select("query_id", "shape", "steps", F.size("terms").alias("n_terms"))
    has_all = sum((F.bit_count(w) for w in words[1:]), F.bit_count(words[0])) == F.col("n_terms")
    holds = F.when(F.col("shape") == "any", True).when(F.col("shape") == "all", has_all)
    holds = holds.otherwise(_holds(F.col("steps"), F.array(*words)))
    matched = found.join(hinted(rules, prepared.small), "query_id").filter(holds)
    return matched.drop("shape", "steps", "n_terms", *[f"_w{w}" for w in range(len(words))])


def _wanted(index: Index, prepared: Prepared) -> DataFrame:
    """Postings of query terms; ``prepared`` is small.

    The terms are distinct, so this keeps rows as a semi join would; but Spark moves a semi
    join below the count of postings, which would then differ from the one terms are counted by.
    """
    return index.postings.join(F.broadcast(prepared.terms.select("field", "term").distinct()), ["field", "term"])


def match_scores(index: Index, queries: "DataFrame | Prepared") -> DataFrame:
    """Rows ``(query_id, doc_id, tfidf, tfidf_smooth)`` of all matching documents.

    Only postings of query terms are kept, at most one per document and term, and
    brought together by document before they meet the queries; so the many rows per query
    and document never cross the network.
    """
    prepared = prepare(queries)
    small = prepared.small
    if small and index.narrow:
        index = index.narrow(prepared.terms)
    weighted = index.terms.join(hinted(prepared.terms, small), ["field", "term"])
    if small:
        hits = _hits(_wanted(index, prepared).repartition("doc_id"), weighted, prepared)
    else:
        # A stop word holds a good part of all postings, so its rows are spread.
        hits = lookup_join(index.postings, weighted, ["field", "term"], ["doc_id"], "inner")
    sums = [F.sum(F.col("tf") * F.col(f"idf_{w}")).alias(name) for w, name in (("standard", "tfidf"), ("smooth", "tfidf_smooth"))]
    return _matched(hits, prepared, sums).select("query_id", "doc_id", "tfidf", "tfidf_smooth")


def best_scores(index: Index, queries: "DataFrame | Prepared", weight: str, k: int, direct: int = DIRECT_HITS) -> DataFrame:
    """Rows ``(query_id, doc_id, score)``, rounded to six digits, of matching documents, without most of those that are not among the best ``k``.

    ``weight`` names a column of the terms. The postings of query terms are stored once, documents grouped by the sum of
    their term frequencies; a document meets a query only if it has a term that is essential for the k-th score.
    Where all documents with all terms of all queries are no more than ``direct`` rows, all matches are scored instead.
    """
    prepared = prepare(queries)
    n_docs = index.postings.sparkSession.range(1).select(index.n_docs).first()[0] if index.n_docs is not None else direct
    if not prepared.small or prepared.n_terms * (n_docs or 0) <= direct:
        name = {"idf_standard": "tfidf", "idf_smooth": "tfidf_smooth"}[weight]
        return match_scores(index, prepared).select("query_id", "doc_id", F.round(name, 6).alias("score"))
    index = index.narrow(prepared.terms) if index.narrow else index.settled() if index.settled else index
    numbers = F.broadcast(numbered(prepared.table.select("query_id")))
    weighted = index.terms.join(F.broadcast(prepared.terms), ["field", "term"]).select(*prepared.terms.columns, "df", F.col(weight).alias("weight"))
    weighted = cut_lineage(weighted.join(numbers, "query_id"))
    rows = placed(_wanted(index, prepared), F.col("tf"))
    needed = cut_lineage(necessary_terms(weighted, prepared).join(numbers, "query_id").drop("query_id")) if prepared.covered else None

    def scores(hits: DataFrame) -> DataFrame:
        score = F.round(F.sum(F.col("impact") * F.col("weight")), 6).alias("score")
        return _matched(hits, prepared, [score, F.first("query").alias("query")])

    return pruned(rows, weighted, scores, k, needed).select("query_id", "doc_id", "score")


def boolean_search(index: Index, queries: "DataFrame | Prepared") -> DataFrame:
    """Rows ``(query_id, doc_id)`` of all matching documents."""
    return match_scores(index, queries).select("query_id", "doc_id")


def _ranked(index: Index, queries: "DataFrame | Prepared", weight: str, k: int, direct: int) -> DataFrame:
    return top_k(best_scores(index, queries, weight, k, direct), ["query_id"], [F.desc("score"), F.asc("doc_id")], k, ["doc_id"])


def rank_tfidf(index: Index, queries: "DataFrame | Prepared", k: int = 5, direct: int = DIRECT_HITS) -> DataFrame:
    """Best ``k`` documents per query by term frequency times log10(N/df); ties by document."""
    return _ranked(index, queries, "idf_standard", k, direct)


def rank_tfidf_smooth(index: Index, queries: "DataFrame | Prepared", k: int = 5, direct: int = DIRECT_HITS) -> DataFrame:
    """Best ``k`` documents per query by term frequency times log10(N/(1+df)) + 1."""
    return _ranked(index, queries, "idf_smooth", k, direct)
