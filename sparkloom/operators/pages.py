"""Page analytics over a table ``(page_id, url, html)``: metadata, link graph, crawl frontier, report."""

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions import html as H, urls as U
from sparkloom.operators.scale import BROADCAST_BYTES, byte_size, cut_lineage, lookup_join, scratch_path


def page_metadata(pages: DataFrame) -> DataFrame:
    """Metadata of stored pages.

    Columns of the fetch (``status_code``, ``response_time``, ``timestamp``,
    ``content_type``, ``page_size_compressed``) are passed through where the table has them.
    """
    passed = [c for c in ("status_code", "timestamp", "page_size_compressed") if c in pages.columns]
    if "response_time" in pages.columns:
        passed.append(F.round("response_time", 3).alias("response_time"))
    if "content_type" in pages.columns:
        passed.append(H.content_type(F.col("content_type")).alias("content_type"))
    html = F.col("html")
    return pages.select(
        "page_id",
        "url",
        *passed,
        H.page_title(html).alias("title"),
        H.canonical_url(html).alias("canonical"),
        H.robots_directive(html).alias("robots"),
        F.length(html).cast("bigint").alias("page_size_uncompressed"),
        F.octet_length(html).cast("bigint").alias("page_size_bytes"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Edges ``(page_id, url, pos, target_url)`` to the page's own site, unique per page.

    All of it happens inside the row: no shuffle.
    """
    links = F.posexplode(H.site_links(F.col("url"), F.col("html"))).alias("pos", "target_url")
    return pages.select("page_id", "url", links)


def _urls(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col("url").alias(name)).distinct()


def next_frontier(
    pages: DataFrame, links: DataFrame, visited: DataFrame, section: str = "animals", expand_details: bool = False
) -> DataFrame:
    """Rows ``(page_id, pos, target_url)`` to fetch next, each target at its first place.

    A target is in the section, not visited, and has no stored page under its slug.
    Detail pages are not expanded.
    """
    edges = links.filter(U.in_section(F.col("target_url"), section))
    if not expand_details:
        edges = edges.filter(~U.is_detail_page(F.col("url"), section))
    # One row per target before the joins: a target that every page links to is one row.
    first = edges.groupBy("target_url").agg(F.min(F.struct("page_id", "pos")).alias("at"))
    fresh = first.join(_urls(visited, "target_url"), "target_url", "left_anti")
    stored = pages.select(U.url_slug(F.col("url")).alias("slug")).distinct()
    fresh = fresh.withColumn("slug", U.url_slug(F.col("target_url")))
    # Slugs leave the host out, so one slug may stand for very many URLs.
    fresh = lookup_join(fresh, stored, ["slug"], ["target_url"], "left_anti")
    return fresh.select("at.page_id", "at.pos", "target_url")


WALK_BUCKETS = 64


def reachable_pages(links: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Rows ``(url, depth)`` of all pages reached from ``seeds (url)`` over ``links (url, target_url)``.

    The edges are stored once, so no round parses a page again. One round per depth adds its pages to one table in
    the shared folder, split by round and by a hash of the URL. A round opens the last round's pages, and of all
    earlier ones just the buckets that its targets fall into; lost executors repeat one round
    only. A round of few bytes is broadcast; larger ones are joined by shuffle, hot sources salted.
    """
    spark = links.sparkSession
    edges = cut_lineage(links.select("url", "target_url").filter(F.col("target_url").isNotNull()).distinct())
    seen, depth = scratch_path(spark, "seen"), 0
    schema = f"url {seeds.schema['url'].dataType.simpleString()}, bucket int, depth int"
    bucket = F.pmod(F.xxhash64("url"), F.lit(WALK_BUCKETS)).cast("int").alias("bucket")
    filled: set[int] = set()  # buckets that hold a page, at most WALK_BUCKETS

    def stored(places: str) -> DataFrame:
        return spark.read.schema(schema).option("basePath", seen).parquet(f"{seen}/{places}")

    def keep(pages: DataFrame, buckets: set[int]) -> None:
        pages.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{seen}/depth={depth}")
        filled.update(buckets)

    def buckets_of(pages: DataFrame) -> set[int]:
        return {r["bucket"] for r in pages.select("bucket").distinct().collect()}

    now = cut_lineage(seeds.select("url", bucket).distinct())
    keep(now, buckets_of(now))
    while filled and (max_depth is None or depth < max_depth):
        small = byte_size(now) <= BROADCAST_BYTES
        out = edges.join(F.broadcast(now), "url", "left_semi") if small else lookup_join(edges, now.select("url"), ["url"], ["target_url"], "inner")
        targets = cut_lineage(out.select(F.col("target_url").alias("url")).distinct().select("url", bucket))
        met = buckets_of(targets)
        if known := ",".join(map(str, sorted(met & filled))):
            targets = targets.join(stored(f"depth=*/bucket={{{known}}}").select("url"), "url", "left_anti")
        now = cut_lineage(targets)
        if now.isEmpty():
            break
        depth += 1
        keep(now, met)
    return spark.read.schema(schema).parquet(seen).select("url", "depth")


def skip_reasons(queue: DataFrame, visited: DataFrame, stored: DataFrame, excluded: tuple[str, ...] = ("/lists/",)) -> DataFrame:
    """Each URL of ``queue`` with what happens to it: visited, invalid, stored or crawl.

    ``visited`` and ``stored`` hold URLs; a page counts as stored when its slug is.
    """
    seen = _urls(visited, "url").withColumn("seen", F.lit(True))
    slugs = stored.select(U.url_slug(F.col("url")).alias("slug")).distinct().withColumn("kept", F.lit(True))
    urls = queue.select("url").distinct().join(seen, "url", "left").withColumn("slug", U.url_slug(F.col("url")))
    reason = (
        F.when(F.col("seen"), "visited")
        .when(~U.is_valid_link(F.col("url"), excluded), "invalid")
        .when(F.col("kept"), "stored")
        .otherwise("crawl")
    )
    return lookup_join(urls, slugs, ["slug"], ["url"], "left").select("url", reason.alias("reason"))


def reason_counts(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("reason").agg(F.count("*").alias("n_urls"))


def crawl_report(metadata: DataFrame, runtime: Column, skipped: Column) -> DataFrame:
    """One row of totals over fetched pages; rates are 0 where the divisor is 0."""
    sums = metadata.agg(
        F.count("*").alias("crawled"),
        F.coalesce(F.sum("response_time"), F.lit(0.0)).alias("response_time"),
        F.coalesce(F.sum("page_size_compressed"), F.lit(0)).alias("compressed_size"),
        F.coalesce(F.sum("page_size_uncompressed"), F.lit(0)).alias("uncompressed_size"),
    )
    rate = F.when(runtime > 0, F.try_divide(F.col("crawled"), runtime))
    return sums.select(
        "crawled",
        skipped.cast("bigint").alias("skipped"),
        F.coalesce(rate, F.lit(0.0)).alias("crawl_rate"),
        F.coalesce(F.try_divide("response_time", "crawled"), F.lit(0.0)).alias("avg_response_time"),
        "compressed_size",
        "uncompressed_size",
    )
