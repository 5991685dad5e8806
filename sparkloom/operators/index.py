"""Inverted index: postings and term statistics as two tables.

A term without a field has ``field = ''``. A field term stands for a key together with a
term; index terms hold no ``_``, so the pair loses nothing against one fused string.
"""

import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sparkloom.fixed_values import FIELD_TERM_MAX_CHARS
from sparkloom.functions.text import format_key, tokenize
from sparkloom.operators.scale import HOT_ROWS, cut_lineage

BUCKETS = 256


class Index(NamedTuple):
    """``postings (field, term, doc_id, tf)`` and ``terms (field, term, df, idf_standard, idf_smooth)``.

    A stored index has ``narrow``: the same index reduced to the rows of wanted terms. One that is made on the way
    has ``settled``: the same index with its postings computed once and stored. ``n_docs`` is the size of the collection, ``tokens`` the rows that
    the postings count, where they are at hand.
    """

    postings: DataFrame
    terms: DataFrame
    narrow: "Callable[[DataFrame], Index] | None" = None
    settled: "Callable[[], Index] | None" = None
    n_docs: Column | None = None
    tokens: DataFrame | None = None


def tokens(leaves: DataFrame) -> DataFrame:
    """One row ``(field, term, doc_id)`` per token of ``leaves (doc_id, key, value)``.

    Short leaves count a second time under their key.
    """
    key = format_key(F.col("key"))
    named = (F.length("value") <= FIELD_TERM_MAX_CHARS) & (key != "")
    fields = F.when(named, F.array(F.lit(""), key)).otherwise(F.array(F.lit("")))
    return leaves.select("doc_id", fields.alias("fields"), F.explode(tokenize(F.col("value"))).alias("term")).select(
        F.explode("fields").alias("field"), "term", "doc_id"
    )


def text_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``(field, term, doc_id)`` per token of a plain text column."""
    return docs.select(
        F.lit("").alias("field"), F.explode(tokenize(F.col(text_col))).alias("term"), F.col(id_col).alias("doc_id")
    )


# Texts that one task counts the tokens of.
TASK_TEXTS = 2_000


def by_document(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` dealt to tasks by id, so that the tokens of an id are counted where they are and no posting is shuffled for it.

    For an index of all terms, as texts take less room than their postings. Where an id (or NULL) has more rows than a task takes,
    ``docs`` stay as they are, and their postings meet by term and document.
    """
    n_rows, most = docs.groupBy(id_col).count().agg(F.sum("count"), F.max("count")).first()
    tasks = -(-(n_rows or 0) // TASK_TEXTS)
    return docs.repartition(tasks, id_col) if tasks > 1 and most <= TASK_TEXTS else docs


def postings(token_rows: DataFrame) -> DataFrame:
    """Term frequency per document. The count starts in the scan task of the document."""
    return token_rows.groupBy("field", "term", "doc_id").agg(F.count("*").alias("tf"))


def idf_standard(df: Column, n_docs: Column) -> Column:
    return F.when(df > 0, F.log10(n_docs / df)).otherwise(F.lit(0.0))


def idf_smooth(df: Column, n_docs: Column) -> Column:
    return F.when(df > 0, F.log10(n_docs / (1 + df)) + 1).otherwise(F.lit(0.0))


def doc_freq(postings_df: DataFrame) -> DataFrame:
    """Documents per term. Counting by ``tf`` keeps the plan equal to the one scoring uses,
    so Spark runs the postings shuffle once for both."""
    return postings_df.groupBy("field", "term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def collection_size(docs: DataFrame) -> Column:
    """Number of documents, those without any token included, as a scalar subquery."""
    return docs.select(F.count("*")).scalar()


def term_stats(postings_df: DataFrame, n_docs: Column) -> DataFrame:
    stats = doc_freq(postings_df)
    return stats.select(
        "field",
        "term",
        "df",
        idf_standard(F.col("df"), n_docs).alias("idf_standard"),
        idf_smooth(F.col("df"), n_docs).alias("idf_smooth"),
    )


def build_index(token_rows: DataFrame, n_docs: Column) -> Index:
    """Index of ``(field, term, doc_id)`` rows from a collection of ``n_docs`` documents."""
    counted = postings(token_rows)

    def settled() -> Index:
        stored = cut_lineage(counted)
        return Index(stored, term_stats(stored, n_docs), n_docs=n_docs)

    return Index(counted, term_stats(counted, n_docs), None, settled, n_docs, token_rows)


def sorted_index(index: Index) -> DataFrame:
    """Postings with their statistics, terms and then documents ascending.

    The postings are computed once and cross the network once, to the place that the order gives them; the documents of a term are counted there.
    A term with more postings than an even share of one partition is sorted by many tasks, by its documents, so its count comes
    from the terms; there are no more such terms than partitions.
    """
    if index.settled:
        index = index.settled()
    dfs = cut_lineage(index.terms.select("field", "term", "df"))
    total, first, last = dfs.agg(F.sum("df"), F.min("field"), F.max("field")).first()
    partitions = int(dfs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = dfs.filter(F.col("df") > max(HOT_ROWS, (total or 0) // partitions)).withColumnRenamed("df", "_df")
    rows = index.postings.join(F.broadcast(frequent), ["field", "term"], "left")
    rows = rows.withColumn("_piece", F.when(F.col("_df").isNotNull(), F.col("doc_id")))
    keys = ["field", "term"]
    if first is not None and first == last:
        # Comparing the one field of all rows would be most of the sort.
        rows, keys = rows.withColumn("field", F.lit(first)), ["term"]
    whole = Window.partitionBy(*keys, "_piece").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.repartitionByRange(*keys, "_piece").withColumn("df", F.coalesce("_df", F.count("*").over(whole)))
    rows = rows.orderBy(*keys, "_piece", "doc_id")
    df = F.col("df")
    weights = idf_standard(df, index.n_docs).alias("idf_standard"), idf_smooth(df, index.n_docs).alias("idf_smooth")
    return rows.select("field", "term", "doc_id", "tf", "df", *weights)


def term_bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64("field", "term"), F.lit(buckets)).cast("int")


# Terms named to the scan itself; more are found by their buckets and the join.
_NAMED_TERMS = 1000


class Commit(NamedTuple):
    """One committed write of a stored index, with its own number of buckets and the columns it stored."""

    batch: str
    buckets: int
    generation: int
    postings: str
    sizes: str


_COMMIT = "batch string, buckets int, generation int, postings string, sizes string"


def _stored(table: DataFrame, path: str, batch: str) -> DataFrame:
    """Write a table with a ``bucket`` as one batch and return what was written.

    Batches are only ever added: what counts is said by the commit rows. Rebalancing splits the bucket of a very
    frequent term into files of normal size.
    """
    placed = table.hint("rebalance", "bucket")
    order = [c for c in ("bucket", "field", "term", "doc_id") if c in table.columns]
    # Named by the folder, the batch is no column of the rows that are shuffled and sorted.
    placed.sortWithinPartitions(*order).write.mode("append").partitionBy("bucket").parquet(f"{path}/batch={batch}")
    kept = [f for f in table.schema.fields if f.name != "bucket"]
    schema = T.StructType([*kept, T.StructField("batch", T.StringType()), T.StructField("bucket", T.IntegerType())])
    return table.sparkSession.read.schema(schema).parquet(path).filter(F.col("batch") == batch)


def store_batch(
    postings_df: DataFrame, sizes: Callable[[DataFrame], DataFrame], path: str, mode: str, buckets: int, beside: dict[str, DataFrame] | None = None
) -> None:
    """Store postings, term counts and ``sizes`` (made from the stored postings), then commit them by one row.

    Tables named in ``beside`` belong to the same batch. The commit is written last and alone: a job that dies before
    leaves files that no reader looks at, and running it again adds nothing twice. ``mode="overwrite"`` starts
    a new generation, which hides all batches before.
    """
    spark, batch = postings_df.sparkSession, uuid.uuid4().hex
    for name, rows in (beside or {}).items():
        rows.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("batch").parquet(f"{path}/{name}")
    stored = _stored(postings_df.withColumn("bucket", term_bucket(buckets)), f"{path}/postings", batch)
    freqs = stored.groupBy("bucket", "field", "term").agg(F.count("*").alias("df"))
    _stored(freqs, f"{path}/freqs", batch)
    size = sizes(stored)
    size.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("batch").parquet(f"{path}/sizes")
    last = max((c.generation for c in _commits(spark, path)), default=0)
    generation = last + 1 if mode == "overwrite" or not last else last
    commit = Commit(batch, buckets, generation, _ddl(postings_df), _ddl(size))
    spark.createDataFrame([commit], _COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _commits(spark: SparkSession, path: str) -> list[Commit]:
    """All commits, one short row per write; none before the first."""
    try:
        return [Commit(*row) for row in spark.read.schema(_COMMIT).parquet(f"{path}/commits").collect()]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


class StoredIndex(NamedTuple):
    """Committed rows of a stored index: ``postings``, ``freqs (field, term, df)`` per batch, ``sizes``."""

    postings: DataFrame
    freqs: DataFrame
    sizes: DataFrame
    batches: tuple[Commit, ...]

    def narrowed(self, wanted: DataFrame) -> "StoredIndex":
        """Only the files of the buckets that wanted terms ``(field, term)`` lie in, by each batch's own number of buckets.

        Up to ``_NAMED_TERMS`` terms are named to the scan too, which skips row groups, as files are sorted by term.
        ``wanted`` must be small; the caller has checked it.
        """
        counts = sorted({b.buckets for b in self.batches})
        places = wanted.select("field", "term", *[term_bucket(n).alias(f"b{n}") for n in counts]).distinct().collect()
        parts = [
            F.col("batch").isin([b.batch for b in self.batches if b.buckets == n]) & F.col("bucket").isin(sorted({p[f"b{n}"] for p in places}))
            for n in counts
        ]
        kept = reduce(Column.__or__, parts, F.lit(False))
        terms = sorted({p["term"] for p in places if p["term"] is not None})
        if len(terms) <= _NAMED_TERMS:
            kept = kept & F.col("term").isin(terms)
        return self._replace(postings=self.postings.filter(kept), freqs=self.freqs.filter(kept))


def read_batches(spark: SparkSession, path: str) -> StoredIndex:
    commits = _commits(spark, path)
    now = max((c.generation for c in commits), default=0)
    batches = tuple(sorted(c for c in commits if c.generation == now))
    if not batches:
        raise ValueError(f"no committed index in {path}")
    mine = F.col("batch").isin([b.batch for b in batches])

    def table(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}").filter(mine)

    placed = ", batch string, bucket int"
    return StoredIndex(
        table("postings", batches[0].postings + placed),
        table("freqs", "field string, term string, df bigint" + placed),
        table("sizes", batches[0].sizes + ", batch string"),
        batches,
    )


def read_beside(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """Rows of a table that was stored beside an index, of committed batches alone."""
    mine = F.col("batch").isin([b.batch for b in read_batches(spark, path).batches])
    return spark.read.schema(f"{schema}, batch string").parquet(f"{path}/{name}").filter(mine).drop("batch")


def write_index(postings_df: DataFrame, n_docs: int, path: str, mode: str = "overwrite", buckets: int = BUCKETS) -> None:
    """Store an index by term bucket, so that a lookup reads the buckets of its terms only.

    Document counts come from the two key columns of the stored postings; the texts are
    not read again. ``mode="append"`` adds the postings of further documents, with any number of buckets.
    """
    size = lambda stored: stored.sparkSession.range(1).select(F.lit(n_docs).cast("bigint").alias("n_docs"))
    store_batch(postings_df, size, path, mode, buckets)


def read_index(spark: SparkSession, path: str) -> Index:
    """Stored index; counts of its committed batches are added up and weighed by all documents."""
    whole = read_batches(spark, path)
    n_docs = whole.sizes.agg(F.sum("n_docs")).scalar()

    def index(part: StoredIndex, narrow) -> Index:
        freqs = part.freqs.groupBy("field", "term").agg(F.sum("df").alias("df"))
        weights = idf_standard(F.col("df"), n_docs).alias("idf_standard"), idf_smooth(F.col("df"), n_docs).alias("idf_smooth")
        return Index(part.postings.drop("batch", "bucket"), freqs.select("field", "term", "df", *weights), narrow, n_docs=n_docs)

    return index(whole, lambda wanted: index(whole.narrowed(wanted), None))


def doc_universe(postings_df: DataFrame) -> DataFrame:
    """All documents that the index knows."""
    return postings_df.select("doc_id").distinct()
