"""Whole jobs: dump to records, pages to facts, two record sets to one, records to a search index.

Every job reads from and writes to folders that all executors reach, and returns what it wrote.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkloom.functions.text import snippet
from sparkloom.operators import facts as X, field_search as B, index as I, leaves as L, matching as M, merging as G, wiki as R
from sparkloom.operators.scale import cut_lineage
from sparkloom.sources import readers, writers


def filter_dump(spark: SparkSession, source: str, target: str, template: str = "speciesbox") -> DataFrame:
    """Keep the pages that use a template, chunk by chunk and whole; returns the report per chunk with totals.

    The dump is read once: one short row per page and the whole of each kept page are stored, and both results come from these.
    """
    pages = readers.read_dump_pages(spark, source)
    counts = cut_lineage(R.marked_pages(pages, template))
    writers.write_filtered_pages(counts.filter("matches").drop("matches"), f"{target}/pages")
    writers.write_stats(R.marks_report(counts), f"{target}/report")
    return spark.read.schema("chunk string, total_pages bigint, matched_pages bigint, has_output boolean").json(f"{target}/report")


def extract_dump(spark: SparkSession, source: str, target: str, template: str = "speciesbox") -> DataFrame:
    """Wiki records of a dump, one per id and one per name, as Parquet.

    Pages are reduced to records inside the scan tasks; only records are shuffled.
    """
    records = R.extract_wiki_records(readers.read_dump_pages(spark, source), template)
    unique = R.dedupe_pages(records, title="animal_name").drop("chunk")
    R.records_by_name(unique).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def extract_pages(spark: SparkSession, source: str, target: str, pattern: str = "*.html") -> DataFrame:
    """Facts records of a folder of HTML files, one per common name, as Parquet."""
    files = readers.read_html_dir(spark, source, pattern)
    pages = files.withColumn("page_id", F.xxhash64("source_file"))
    X.facts_dataset(X.extract_facts(pages)).drop("page_id").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


class Merged(NamedTuple):
    """Result of ``match_and_merge``."""

    records: DataFrame
    matches: DataFrame
    stats: DataFrame


def match_and_merge(left: DataFrame, right: DataFrame, target: str) -> Merged:
    """Match ``left (key, ...)`` with ``right (wiki_key, ...)``, merge, and add the unmatched right records.

    The matcher runs once: its narrow result is stored, and the merge, the right-only
    records and the statistics read it back.
    """
    spark = left.sparkSession
    M.match_entities(M.left_rows(left), M.right_rows(right)).write.mode("overwrite").parquet(f"{target}/matches")
    matches = spark.read.parquet(f"{target}/matches")
    merged, rest = G.counted_flags(G.merge_records(left, right, matches)), G.right_only(right, matches)
    G.merged_union(G.finish_merged(merged), rest).write.mode("overwrite").parquet(f"{target}/records")
    records = spark.read.parquet(f"{target}/records")
    G.match_stats(records).write.mode("overwrite").parquet(f"{target}/stats")
    return Merged(records.drop("n_appended", "n_alternatives"), matches, spark.read.parquet(f"{target}/stats"))


def index_texts(docs: DataFrame, target: str, mode: str = "overwrite", buckets: int = I.BUCKETS) -> I.Index:
    """Store the term index of ``docs (doc_id, text)``."""
    I.write_index(I.postings(I.text_tokens(I.by_document(docs))), docs.count(), target, mode, buckets)
    return I.read_index(docs.sparkSession, target)


def index_records(records: DataFrame, target: str, mode: str = "overwrite", buckets: int = I.BUCKETS) -> I.Index:
    """Store the term index of ``records (doc_id, ...)``, with field terms of their keys."""
    tokens = I.tokens(L.record_leaves(records, "doc_id"))
    I.write_index(I.postings(tokens), records.count(), target, mode, buckets)
    return I.read_index(records.sparkSession, target)


def create_search_index(records: DataFrame, target: str, mode: str = "overwrite", buckets: int = I.BUCKETS) -> B.FieldIndex:
    """Store the multi-field index of JSON records ``(name, record)``; the name is the document id.

    Name, content and, where there is one, the ``source`` path are stored beside it (``indexed_documents``). Records that
    are no JSON are left out and stored beside it too (``rejected_records``). All become visible by one commit: a write
    that dies half-way shows nothing and can be repeated.
    """
    parsed = records.withColumn("value", F.try_parse_json("record"))
    source = F.col("source") if "source" in records.columns else F.lit(None).cast("string")
    docs = B.search_documents(parsed.withColumn("source", source), F.col("name"), L.variant_leaves(F.col("value")), "name", ["source", "record", "value"])
    # Parsed and opened once; the index, the stored texts and the bad records all read this table.
    docs = cut_lineage(docs.withColumn("bad", F.col("value").isNull()).drop("value"))
    good = docs.filter("not bad")
    beside = {
        "documents": good.select("doc_id", "name", "content", "source"),
        "rejected": docs.filter("bad").select(F.col("doc_id").alias("name"), "record"),
    }
    B.write_field_index(B.field_index(B.field_documents(good)), target, mode, buckets, beside)
    return B.read_field_index(records.sparkSession, target)


def indexed_documents(spark: SparkSession, target: str) -> DataFrame:
    """Rows ``(doc_id, name, content, source)`` of the committed documents of a search index."""
    return I.read_beside(spark, target, "documents", "doc_id string, name string, content string, source string")


def rejected_records(spark: SparkSession, target: str) -> DataFrame:
    """Rows ``(name, record)`` that a search index has left out."""
    return I.read_beside(spark, target, "rejected", "name string, record string")


def search_results(index: B.FieldIndex, queries: DataFrame, contents: DataFrame, k: int = 5) -> DataFrame:
    """Ranked results ``(query_id, rank, doc_id, score, snippet)``; ``contents`` holds ``(doc_id, content)``."""
    best = B.search_fields(index, queries, k=k)
    return best.join(contents, "doc_id").select("query_id", "rank", "doc_id", "score", snippet(F.col("content")).alias("snippet"))
