"""Writers. Results are folders of files, written by all executors."""

from pyspark.sql import DataFrame, functions as F

from sparkloom.fixed_values import METADATA_HEADER


def write_metadata_csv(metadata: DataFrame, path: str) -> None:
    """Append page metadata as CSV with the fixed header; columns not at hand are empty."""
    columns = [
        (F.col(c) if c in metadata.columns else F.lit(None)).cast("string").alias(title)
        for c, title in METADATA_HEADER.items()
    ]
    metadata.select(*columns).write.mode("append").option("header", True).option("escape", '"').csv(path)


def append_url_set(urls: DataFrame, path: str) -> None:
    """Append URLs, one per line."""
    urls.select("url").write.mode("append").text(path)


def write_keyed_records(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Records as JSON lines without NULL fields."""
    records.write.mode(mode).json(path)


def write_filtered_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pages ``(wiki_id, title, text, chunk)``, whole if with ``page``, as XML, one folder per chunk; no folder for a chunk without pages.

    Rebalancing keeps the number of files small and splits a chunk that holds most pages.
    """
    named = F.regexp_replace("chunk", r"(?:_filtered)?\.xml$", "")
    rows = _as_dump(pages).withColumn("chunk", F.concat(named, F.lit("_filtered.xml")))
    writer = rows.hint("rebalance", "chunk").write.mode(mode).partitionBy("chunk")
    writer.option("rootTag", "mediawiki").option("rowTag", "page").xml(path)


def write_merged_chunks(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All pages ``(wiki_id, title, text, chunk_no)``, whole if with ``page``, as one XML data set in chunk order.

    The id is part of the sort key, so a chunk that holds most pages is split as well.
    """
    ordered = pages.orderBy("chunk_no", "wiki_id", "title")
    _as_dump(ordered, chunk=False).write.mode(mode).option("rootTag", "mediawiki").option("rowTag", "page").xml(path)


def _as_dump(pages: DataFrame, chunk: bool = True) -> DataFrame:
    """Whole pages where ``page`` is at hand, else pages made of title, id and text."""
    if "page" in pages.columns:
        parts = ["page.*"]
    else:
        parts = ["title", F.col("wiki_id").alias("id"), F.struct(F.col("text").alias("text")).alias("revision")]
    return pages.select(*parts, *(["chunk"] if chunk else []))


def merge_summary(pages: DataFrame) -> DataFrame:
    """One row ``(total_pages, files_merged)`` over filtered chunks."""
    per_file = pages.groupBy("chunk").agg(F.count("*").alias("n"))
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_pages"), F.count("*").alias("files_merged")
    )


def write_stats(stats: DataFrame, path: str) -> None:
    """One-row statistics as JSON next to a result."""
    stats.write.mode("overwrite").json(path)
