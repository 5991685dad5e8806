"""Multi-field full-text search scored with BM25, for many queries at once."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkloom.fixed_values import BM25_B, BM25_K1
from sparkloom.functions.columns import bind
from sparkloom.functions.text import analyze
from sparkloom.operators.index import BUCKETS, StoredIndex, read_batches, store_batch
from sparkloom.operators.leaves import content
from sparkloom.operators.scale import cut_lineage, hinted, lookup_join, settle, top_k
from sparkloom.operators.topk import DIRECT_HITS, numbered, placed, pruned

NAME, CONTENT, EXACT = "name", "content", "exact_name"


class FieldIndex(NamedTuple):
    """``postings (field, term, doc_id, dl, tf)``, ``terms (field, term, df)``, ``stats (field, n_docs, total)``.

    A stored index has ``narrow``: the same index reduced to the rows of wanted terms. One that is made on the way
    has ``settled``: the same index with its postings computed once and stored.
    """

    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    narrow: "Callable[[DataFrame], FieldIndex] | None" = None
    settled: "Callable[[], FieldIndex] | None" = None


def search_documents(
    df: DataFrame, name: Column, leaves: Column, id_col: str = "doc_id", stored: list[str] | None = None
) -> DataFrame:
    """Rows ``(doc_id, name, content, leaves)`` to index: ``leaves`` comes from ``sparkloom.operators.leaves``.

    Columns named in ``stored`` are kept next to them and not searched.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), name.alias("name"), leaves.alias("leaves"), *(stored or []))
    return rows.withColumn("content", content(F.col("leaves"), F.col("name")))


def field_documents(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, field, tokens)``: every leaf under its path and under its last key,
    the name, the content, and the unsplit name as ``exact_name``.

    Values of one field are joined inside the row of the document, without a shuffle.
    """
    value = lambda field, text: F.struct(field.alias("field"), analyze(text).alias("tokens"))
    by_leaf = F.flatten(
        F.transform(
            F.filter("leaves", lambda n: n["value"] != ""),
            lambda n: F.transform(
                F.array_distinct(F.array(n["path"], F.substring_index(n["path"], ".", -1))),
                lambda f: value(f, n["value"]),
            ),
        )
    )
    whole = F.array(value(F.lit(NAME), F.col("name")), value(F.lit(CONTENT), F.col("content")))
    exact = F.array(F.struct(F.lit(EXACT).alias("field"), F.array("name").alias("tokens")))

    def grouped(parts: Column) -> Column:
        names = F.array_distinct(F.transform(parts, lambda p: p["field"]))
        return F.transform(
            names,
            lambda f: F.struct(
                f.alias("field"),
                F.flatten(
                    F.transform(F.filter(parts, lambda p: p["field"] == f), lambda p: p["tokens"])
                ).alias("tokens"),
            ),
        )

    fields = bind(F.concat(by_leaf, whole, exact), grouped)
    return docs.select("doc_id", F.explode(fields).alias("f")).select("doc_id", "f.field", "f.tokens")


def text_fields(df: DataFrame, columns: dict[str, Column], id_col: str = "doc_id") -> DataFrame:
    """Rows ``(doc_id, field, tokens)`` of plain text columns; ``exact_name`` stays unsplit."""
    fields = [
        F.struct(F.lit(f).alias("field"), (F.array(c) if f == EXACT else analyze(c)).alias("tokens"))
        for f, c in columns.items()
    ]
    return df.select(F.col(id_col).alias("doc_id"), F.explode(F.array(*fields)).alias("f")).select(
        "doc_id", "f.field", "f.tokens"
    )


_WHOLE = "\0"


def field_index(rows: DataFrame, only: DataFrame | None = None) -> FieldIndex:
    """Index of ``(doc_id, field, tokens)``; with ``only (field, term)`` just of these terms.

    The field length travels with the posting, so scoring needs no join with a length table.
    """
    rows = rows.filter(F.size("tokens") > 0)
    length = F.size("tokens").cast("bigint")
    # A term of its own stands for the document's field as a whole, so lengths come from the same pass as postings.
    # Joins need both keys; saying so here keeps the two uses of the pass equal, and Spark runs it once.
    terms = F.concat(F.array(F.lit(_WHOLE)), F.col("tokens"))
    tokens = rows.select("doc_id", "field", length.alias("dl"), F.explode(terms).alias("term"))
    tokens = tokens.filter(F.col("field").isNotNull() & F.col("term").isNotNull())
    if only is not None:
        only, small = settle(only)
        if small:
            flagged = tokens.join(F.broadcast(only.withColumn("_wanted", F.lit(True))), ["field", "term"], "left")
            tokens = flagged.filter(F.col("_wanted") | (F.col("term") == _WHOLE)).drop("_wanted")
        else:
            counted = tokens.filter(F.col("term") != _WHOLE).groupBy("field", "term", "doc_id", "dl").agg(F.count("*").alias("tf"))
            postings = lookup_join(counted, only, ["field", "term"], ["doc_id"], "left_semi")
            return _field_index(postings, tokens.filter(F.col("term") == _WHOLE).withColumn("tf", F.lit(1)))
    counted = tokens.groupBy("field", "term", "doc_id", "dl").agg(F.count("*").alias("tf"), F.bool_or(F.col("term") == _WHOLE).alias("_whole"))

    def index(rows: DataFrame) -> FieldIndex:
        return _field_index(rows.filter(~F.col("_whole")).drop("_whole"), rows.filter("_whole").drop("_whole"))

    return index(counted)._replace(settled=lambda: index(cut_lineage(counted)))


def _field_index(postings: DataFrame, whole: DataFrame) -> FieldIndex:
    terms = postings.groupBy("field", "term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    stats = whole.groupBy("field").agg(F.count_if(F.col("tf") > 0).alias("n_docs"), F.sum("dl").alias("total"))
    return FieldIndex(postings, terms, stats)


def write_field_index(index: FieldIndex, path: str, mode: str = "overwrite", buckets: int = BUCKETS, beside: dict[str, DataFrame] | None = None) -> None:
    """Store the index by term bucket; ``mode="append"`` adds further documents, with any number of buckets.

    Tables named in ``beside`` are committed together with it.
    """
    store_batch(index.postings, lambda _: index.stats, path, mode, buckets, beside)


def read_field_index(spark: SparkSession, path: str) -> FieldIndex:
    """Stored index; counts and lengths of its committed batches are added up."""
    whole = read_batches(spark, path)
    stats = whole.sizes.groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("total").alias("total"))

    def index(part: StoredIndex, narrow) -> FieldIndex:
        terms = part.freqs.groupBy("field", "term").agg(F.sum("df").alias("df"))
        return FieldIndex(part.postings.drop("batch", "bucket"), terms, stats, narrow)

    return index(whole, lambda wanted: index(whole.narrowed(wanted), None))


def field_query_terms(queries: DataFrame, fields: tuple[str, ...] = (NAME, CONTENT, EXACT)) -> DataFrame:
    """Rows ``(query_id, field, term, qtf)`` of ``(query_id, text)``.

    A query row with a ``field`` searches that field only. A NULL text has no terms.
    """
    if "field" not in queries.columns:
        queries = queries.withColumn("field", F.lit(None).cast("string"))
    scoped = queries.select(
        "query_id",
        "text",
        F.explode(F.when(F.col("field").isNotNull(), F.array("field")).otherwise(F.array(*map(F.lit, fields)))).alias("field"),
    )
    terms = F.when(F.col("field") == EXACT, F.array("text")).otherwise(analyze(F.col("text")))
    rows = scoped.select("query_id", "field", F.explode(terms).alias("term")).filter(F.col("term").isNotNull())
    return rows.groupBy("query_id", "field", "term").agg(F.count("*").alias("qtf"))


def stored_length(dl: Column) -> Column:
    """Length as the norms keep it: exact up to 40, beyond that the four leading bits count."""
    over = dl - 24
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.length(F.bin(over)) - 4, F.lit(0)))
    return F.when(dl < 24, dl).otherwise(24 + F.floor(over / step) * step)


def term_weight(df: Column, n_docs: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, dl: Column, n_docs: Column, total: Column) -> Column:
    """What a posting adds per unit of its term's weight."""
    return tf / (tf + BM25_K1 * (1 - BM25_B + BM25_B * dl / (total / n_docs)))


def bm25(tf: Column, df: Column, dl: Column, n_docs: Column, total: Column) -> Column:
    return term_weight(df, n_docs) * saturation(tf, dl, n_docs, total)


def _weighted(index: FieldIndex, wanted: DataFrame, small: bool) -> DataFrame:
    """``wanted`` with the statistics of its terms and fields."""
    weighted = index.terms.join(hinted(wanted, small), ["field", "term"])
    # At most one row per wanted term is left of the statistics.
    stats = index.stats.join(hinted(wanted.select("field").distinct(), small), "field", "left_semi")
    return weighted.join(hinted(stats, small), "field")


def field_scores(index: FieldIndex, wanted: DataFrame, exact_lengths: bool = False) -> DataFrame:
    """Rows ``(query_id, doc_id, score)``: BM25 summed over the terms and fields of ``wanted``."""
    wanted, small = settle(wanted)
    if small and index.narrow:
        index = index.narrow(wanted)
    postings = index.postings
    weighted = _weighted(index, wanted, small)
    if small:
        # A document's postings of query terms meet before they multiply by queries.
        kept = F.broadcast(wanted.select("field", "term").distinct())
        hits = postings.join(kept, ["field", "term"]).repartition("doc_id").join(F.broadcast(weighted), ["field", "term"])
    else:
        # A stop word holds a good part of all postings, so its rows are spread.
        hits = lookup_join(postings, weighted, ["field", "term"], ["doc_id"], "inner")
    dl = F.col("dl") if exact_lengths else stored_length(F.col("dl"))
    score = F.col("qtf") * bm25(F.col("tf"), F.col("df"), dl, F.col("n_docs"), F.col("total"))
    return hits.groupBy("query_id", "doc_id").agg(F.sum(score).alias("score"))


def best_field_scores(index: FieldIndex, wanted: DataFrame, k: int, exact_lengths: bool = False, direct: int = DIRECT_HITS) -> DataFrame:
    """``field_scores`` rounded to six digits, without most of the documents that are not among the best ``k`` of a query.

    A posting's impact (its saturated frequency) does not depend on the query, so documents are grouped by the sum of
    theirs, and a document meets a query only if it has a term that is essential for the k-th score.
    Where the queries have no more than ``direct`` postings to meet, all matches are scored instead.
    """
    wanted, small = settle(wanted)
    if small:
        index = index.narrow(wanted) if index.narrow else index.settled() if index.settled else index
        hits = index.terms.join(F.broadcast(wanted), ["field", "term"]).agg(F.sum("df")).first()[0] or 0
    if not small or hits <= direct:
        return field_scores(index, wanted, exact_lengths).withColumn("score", F.round("score", 6))
    numbers = numbered(wanted.select("query_id"))
    weight = F.col("qtf") * term_weight(F.col("df"), F.col("n_docs"))
    weighted = _weighted(index, wanted, small).join(F.broadcast(numbers), "query_id").select("query", "field", "term", weight.alias("weight"))
    weighted = cut_lineage(weighted)
    dl = F.col("dl") if exact_lengths else stored_length(F.col("dl"))
    kept = index.postings.join(F.broadcast(wanted.select("field", "term").distinct()), ["field", "term"]).join(F.broadcast(index.stats), "field")
    rows = placed(kept, saturation(F.col("tf"), dl, F.col("n_docs"), F.col("total")))

    def scores(hits: DataFrame) -> DataFrame:
        return hits.groupBy("query", "doc_id").agg(F.round(F.sum(F.col("impact") * F.col("weight")), 6).alias("score"))

    return pruned(rows, weighted, scores, k).join(F.broadcast(numbers), "query").select("query_id", "doc_id", "score")


def search_fields(
    index: FieldIndex,
    queries: DataFrame,
    fields: tuple[str, ...] = (NAME, CONTENT, EXACT),
    k: int = 5,
    exact_lengths: bool = False,
    direct: int = DIRECT_HITS,
) -> DataFrame:
    """Best ``k`` documents per query ``(query_id, text)``, score summed over fields; ties by document."""
    rounded = best_field_scores(index, field_query_terms(queries, fields), k, exact_lengths, direct)
    return top_k(rounded, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, ["doc_id"])
