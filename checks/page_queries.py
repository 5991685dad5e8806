"""Page metadata, links, frontier and crawl report."""

from pyspark.sql import functions as F

from checks import fixtures
from checks.index_queries import read
from sparkloom.functions import html as H, text as T, urls as U
from sparkloom.operators import pages as P
from sparkloom.operators.scale import scratch_path
from sparkloom.sources import readers, writers


def pages(spark, sf_dir):
    return read(spark, sf_dir, "pages")


def page_metadata(spark, sf_dir):
    return P.page_metadata(pages(spark, sf_dir))


def fact_page_metadata(spark, sf_dir):
    """Head data of pages that have canonical and robots entries, with columns of the fetch."""
    fetched = fixtures.html(spark, sf_dir).select(
        "page_id",
        F.concat(F.lit("https://x.test/animals/"), "page_id").alias("url"),
        "html",
        F.lit(200).alias("status_code"),
        (F.col("page_id") / 7).alias("response_time"),
        F.when(F.col("page_id") % 2 == 0, F.lit("text/html; charset=utf-8")).alias("content_type"),
    )
    return P.page_metadata(fetched)


def page_links(spark, sf_dir):
    links = P.page_links(pages(spark, sf_dir))
    return links.select("page_id", "url", F.col("pos").cast("bigint").alias("pos"), "target_url")


def page_slug(spark, sf_dir):
    links = P.page_links(pages(spark, sf_dir))
    return links.select("page_id", "target_url", U.url_slug(F.col("url")).alias("slug"), U.url_slug(F.col("target_url")).alias("target_slug"))


def page_link_filters(spark, sf_dir):
    url, target = F.col("url"), F.col("target_url")
    return P.page_links(pages(spark, sf_dir)).select(
        "page_id",
        "target_url",
        U.is_detail_page(url, "en").alias("is_detail"),
        U.is_valid_link(target, ("/th", "/le")).alias("is_valid"),
        U.same_site(url, target).alias("is_same_site"),
        U.in_section(url, "en").alias("is_in_section"),
        U.url_netloc(url).alias("netloc"),
        U.url_path(url).alias("path"),
    )


HREFS = ("x/y", "../up", "./a/./b/../c", "?q=1", "#frag", "//other.test/p", "https://abs.test/a?b#c", "mailto:a@b.test", "/root/../z", "", "/plain", "a;p=1/b")


def resolve_url(spark, sf_dir):
    """Every kind of reference against the URL of every page."""
    kind = F.pmod(F.col("page_id"), F.lit(len(HREFS))).cast("int")
    rows = pages(spark, sf_dir).select("page_id", "url", F.get(F.array(*map(F.lit, HREFS)), kind).alias("href"))
    return rows.select("page_id", "href", U.resolve_url(F.col("url"), F.col("href")).alias("resolved"))


def _visited(spark, sf_dir):
    """Every third target of the links has been visited."""
    links = P.page_links(pages(spark, sf_dir)).select(F.col("target_url").alias("url")).distinct()
    return links.filter(F.length("url") % 3 == 0)


def _sectioned(spark, sf_dir):
    """Pages of which every other one links into the section ``en``; the rest link from the root."""
    moved = F.regexp_replace("html", 'href="/', 'href="/en/')
    return pages(spark, sf_dir).withColumn("html", F.when(F.col("page_id") % 2 == 0, moved).otherwise(F.col("html")))


def next_frontier(spark, sf_dir):
    """Targets in a section; its own detail pages are not expanded."""
    table = _sectioned(spark, sf_dir)
    links = P.page_links(table)
    visited = links.select(F.col("target_url").alias("url")).distinct().filter(F.length("url") % 3 == 0)
    found = P.next_frontier(table, links, visited, section="en")
    return found.withColumn("pos", F.col("pos").cast("bigint"))


def next_frontier_details(spark, sf_dir):
    """Every target, details expanded."""
    table = pages(spark, sf_dir)
    found = P.next_frontier(table, P.page_links(table), _visited(spark, sf_dir), section="", expand_details=True)
    return found.withColumn("pos", F.col("pos").cast("bigint"))


def skip_reasons(spark, sf_dir):
    table = pages(spark, sf_dir)
    queue = P.page_links(table).select(F.col("target_url").alias("url")).unionByName(table.select("url"))
    return P.skip_reasons(queue, _visited(spark, sf_dir), table, ("/th",))


def skip_counts(spark, sf_dir):
    return P.reason_counts(skip_reasons(spark, sf_dir))


def _trade(spark, sf_dir):
    """Links between parts and suppliers of the same order line, as one graph."""
    lines = read(spark, sf_dir, "lineitem")
    part, supp = F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("s"), "l_suppkey")
    edges = lines.select(part.alias("url"), supp.alias("target_url"))
    back = lines.select(supp.alias("url"), part.alias("target_url"))
    return edges.unionByName(back)


def reachable_pages(spark, sf_dir):
    seeds = read(spark, sf_dir, "supplier").agg(F.concat(F.lit("s"), F.min("s_suppkey")).alias("url"))
    return P.reachable_pages(_trade(spark, sf_dir), seeds)


def reachable_in_two(spark, sf_dir):
    """The same walk, cut after two rounds."""
    seeds = read(spark, sf_dir, "supplier").agg(F.concat(F.lit("s"), F.min("s_suppkey")).alias("url"))
    return P.reachable_pages(_trade(spark, sf_dir), seeds, max_depth=2)


def crawl_report(spark, sf_dir):
    events = read(spark, sf_dir, "events").select(
        F.col("value").alias("response_time"),
        F.length("props").alias("page_size_compressed"),
        F.col("user_id").alias("page_size_uncompressed"),
    )
    report = P.crawl_report(events, F.lit(120.0), F.lit(7))
    return report.withColumns({c: F.round(c, 4) for c in ("crawl_rate", "avg_response_time")})


def decode_entities(spark, sf_dir):
    html = F.col("html")
    return pages(spark, sf_dir).select("page_id", T.decode_entities(H.page_title(html)).alias("title"), T.decode_entities(html).alias("page"))


def unescape_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.unescape_html(F.col("html")).alias("page"))


def unescape_entities(spark, sf_dir):
    """Every page number as references: decimal, hexadecimal, a name with and without semicolon."""
    number = F.col("page_id") + 161
    text = F.concat(F.lit("&#"), number, F.lit("; &#x"), F.lower(F.hex(number)), F.lit("; &eacute; &eacutes &lt &#"), number, F.lit(" &unknown;"))
    return pages(spark, sf_dir).select("page_id", T.unescape_html(text).alias("page"))


def html_headline(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", H.headline(F.col("html")).alias("headline"))


def html_list_items(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.array_join(H.linked_items(F.col("html")), "|").alias("items"))


def strip_tags(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", H.strip_tags(F.col("html")).alias("page_text"))


def url_set_round_trip(spark, sf_dir):
    """Link targets appended twice as text, read back as a set."""
    path = scratch_path(spark, "urls")
    targets = P.page_links(pages(spark, sf_dir)).select(F.col("target_url").alias("url"))
    for _ in range(2):
        writers.append_url_set(targets, path)
    return readers.read_url_set(spark, path)


def metadata_round_trip(spark, sf_dir):
    """Page metadata written as CSV and read back."""
    path = scratch_path(spark, "metadata")
    writers.write_metadata_csv(P.page_metadata(pages(spark, sf_dir)), path)
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.select(
        F.col("URL").alias("url"), F.col("HTML Title").alias("title"), F.col("`Page Size (Uncompressed Bytes)`").alias("size")
    )


def html_dir_round_trip(spark, sf_dir):
    """Pages written as one folder of text files, found again by pattern."""
    path = scratch_path(spark, "html")
    table = pages(spark, sf_dir)
    table.select("html").write.option("lineSep", "\n").text(path)
    files = readers.read_html_dir(spark, path, "part-*.txt")
    lines = files.select(F.explode(F.split("html", "\n")).alias("html")).filter(F.col("html") != "")
    return lines.select(F.md5("html").alias("digest"), F.length("html").cast("bigint").alias("n_chars"))


QUERIES = {
    f.__name__: f
    for f in (
        page_metadata,
        fact_page_metadata,
        page_links,
        page_slug,
        page_link_filters,
        resolve_url,
        next_frontier,
        next_frontier_details,
        skip_reasons,
        skip_counts,
        reachable_pages,
        reachable_in_two,
        crawl_report,
        decode_entities,
        unescape_html,
        unescape_entities,
        html_headline,
        html_list_items,
        strip_tags,
        url_set_round_trip,
        metadata_round_trip,
        html_dir_round_trip,
    )
}

TITLE = "trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1))"
NETLOC = r"regexp_extract(URL, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)"
ROOT = r"regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
PATH = r"regexp_replace(regexp_extract(URL, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
SLUG = f"replace(trim({PATH}, '/'), '/', '_')"


def slug(url):
    name = SLUG.replace("URL", url)
    return f"case when {name} = '' then 'index.html' when {name} like '%.html' then {name} else {name} || '.html' end"


# All given links start at the root of their own site.
LINKS = f"""
hrefs as (select page_id, url, {ROOT} || href as target_url, i from (
  select page_id, url, unnest(regexp_extract_all(html, '(?i)<a[^>]+href=[''"](.*?)[''"][^>]*>', 1)) as href,
   generate_subscripts(regexp_extract_all(html, '(?i)<a[^>]+href=[''"](.*?)[''"][^>]*>', 1), 1) as i from pages) h),
firsts as (select page_id, url, target_url, min(i) as i from hrefs group by all),
links as (select page_id, url, row_number() over (partition by page_id order by i) - 1 as pos, target_url from firsts)
"""
VISITED = "visited as (select distinct target_url as url from links where length(target_url) % 3 = 0)"


def _entities(col):
    from sparkloom.fixed_values import HTML_ENTITIES

    for name, value in sorted(HTML_ENTITIES.items(), key=lambda x: x[0] == "&amp;"):
        name, value = (s.replace("'", "''") for s in (name, value))
        col = f"replace({col}, '{name}', '{value}')"
    return col


_FOLDER = f"case when {PATH} = '' then '/' else regexp_extract({PATH}, '^(.*/)', 1) end".replace("URL", "url")
_PARENT = f"regexp_extract({_FOLDER}, '^(.*/)[^/]+/$', 1)"
_QUERY = r"regexp_extract(url, '^[^?#]*(\?[^#]+)', 1)"
_FULLPATH = PATH.replace("URL", "url")

_RESOLVED = f"""case page_id % 12
 when 0 then {ROOT} || {_FOLDER} || 'x/y'
 when 1 then {ROOT} || case when {_PARENT} = '' then '/' else {_PARENT} end || 'up'
 when 2 then {ROOT} || {_FOLDER} || 'a/c'
 when 3 then {ROOT} || {_FULLPATH} || '?q=1'
 when 4 then {ROOT} || {_FULLPATH} || {_QUERY} || '#frag'
 when 5 then regexp_extract(url, '^([a-z]+:)', 1) || '//other.test/p'
 when 6 then 'https://abs.test/a?b#c' when 7 then 'mailto:a@b.test'
 when 8 then {ROOT} || '/z' when 9 then url when 10 then {ROOT} || '/plain'
 else {ROOT} || {_FOLDER} || 'a;p=1/b' end"""

_REASONS = f"""
queue as (select distinct target_url as url from links union select url from pages),
slugs as (select distinct {slug('url')} as slug from pages),
reasons as (select url, case when url in (select url from visited) then 'visited' when contains(lower({PATH.replace('URL', 'url')}), '/th') then 'invalid'
  when {slug('url')} in (select slug from slugs) then 'stored' else 'crawl' end as reason from queue)
"""

# No shortest path in these tables is near forty steps long.
_WALK = """with recursive edges as (
        select 'p' || l_partkey as url, 's' || l_suppkey as target_url from lineitem union select 's' || l_suppkey, 'p' || l_partkey from lineitem),
      walk(url, depth) as (select 's' || min(s_suppkey), 0 from supplier union
        select target_url, depth + 1 from walk join edges using (url) where depth < {most})
      select url, min(depth) as depth from walk group by url"""

ORACLES = {
    "page_metadata": f"""select page_id, url, {TITLE} as title, '' as canonical, '' as robots,
      cast(length(html) as bigint) as page_size_uncompressed, cast(strlen(html) as bigint) as page_size_bytes from pages""",
    "fact_page_metadata": f"""with fx as ({fixtures.for_duckdb(fixtures.HTML)})
      select page_id, 'https://x.test/animals/' || page_id as url, 200 as status_code, round(page_id / 7, 3) as response_time,
      case when page_id % 2 = 0 then 'text/html' else '' end as content_type, '' as title,
      'https://x.test/animals/' || page_id || '/' as canonical, 'index' as robots,
      cast(length(html) as bigint) as page_size_uncompressed, cast(strlen(html) as bigint) as page_size_bytes from fx""",
    "page_links": f"with {LINKS} select page_id, url, pos, target_url from links",
    "page_slug": f"with {LINKS} select page_id, target_url, {slug('url')} as slug, {slug('target_url')} as target_slug from links",
    "page_link_filters": f"""with {LINKS} select page_id, target_url,
      regexp_matches({PATH.replace('URL', 'url')}, '^/*en/[^/]') as is_detail,
      not (contains(lower({PATH.replace('URL', 'target_url')}), '/th') or contains(lower({PATH.replace('URL', 'target_url')}), '/le')) as is_valid,
      {NETLOC.replace('URL', 'url')} = {NETLOC.replace('URL', 'target_url')} as is_same_site, contains(url, '/en/') as is_in_section,
      {NETLOC.replace('URL', 'url')} as netloc, {PATH.replace('URL', 'url')} as path from links""",
    "resolve_url": "select page_id, ["
    + ", ".join(f"'{h}'" for h in HREFS)
    + f"][1 + page_id % {len(HREFS)}] as href, {_RESOLVED} as resolved from pages",
    "next_frontier": f"""with {LINKS.replace('from pages', "from (select page_id, url, case when page_id % 2 = 0 then replace(html, 'href=" + chr(34) + "/', 'href=" + chr(34) + "/en/') else html end as html from pages) p")}, {VISITED},
      ranked as (select page_id, pos, target_url, row_number() over (partition by target_url order by page_id, pos) as n from links
        where contains(target_url, '/en/') and not regexp_matches({PATH.replace('URL', 'url')}, '^/*en/[^/]'))
      select page_id, pos, target_url from ranked where n = 1 and target_url not in (select url from visited)
       and {slug('target_url')} not in (select {slug('url')} from pages)""",
    "next_frontier_details": f"""with {LINKS}, {VISITED},
      ranked as (select page_id, pos, target_url, row_number() over (partition by target_url order by page_id, pos) as n from links)
      select page_id, pos, target_url from ranked where n = 1 and target_url not in (select url from visited)
       and {slug('target_url')} not in (select {slug('url')} from pages)""",
    "skip_reasons": f"with {LINKS}, {VISITED}, {_REASONS} select * from reasons",
    "skip_counts": f"with {LINKS}, {VISITED}, {_REASONS} select reason, count(*) as n_urls from reasons group by reason",
    "reachable_pages": _WALK.format(most=40),
    "reachable_in_two": _WALK.format(most=2),
    "crawl_report": """select count(*) as crawled, cast(7 as bigint) as skipped, round(count(*) / 120.0, 4) as crawl_rate,
      round(sum(value) / count(*), 4) as avg_response_time, cast(sum(length(props)) as bigint) as compressed_size,
      cast(sum(user_id) as bigint) as uncompressed_size from events""",
    "decode_entities": f"select page_id, {_entities(TITLE)} as title, {_entities('html')} as page from pages",
    "unescape_html": "select page_id, replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&') as page from pages",
    "unescape_entities": "select page_id, chr(cast(page_id + 161 as integer)) || ' ' || chr(cast(page_id + 161 as integer)) || ' é és < ' || chr(cast(page_id + 161 as integer)) || ' &unknown;' as page from pages",
    "html_headline": f"select page_id, {_entities('trim(regexp_extract(html, $$(?i)<h1[^>]*>([^<]+)</h1>$$, 1))')} as headline from pages",
    "html_list_items": "select page_id, array_to_string(list_transform(regexp_extract_all(html, '(?i)<li><a[^>]*>([^<]+)</a></li>', 1), lambda x: trim(x)), '|') as items from pages",
    "strip_tags": "select page_id, regexp_replace(html, '<[^>]+>', '', 'g') as page_text from pages",
    "url_set_round_trip": f"with {LINKS} select distinct target_url as url from links",
    "metadata_round_trip": f"select url, {TITLE} as title, cast(length(html) as varchar) as size from pages",
    "html_dir_round_trip": """select md5(line) as digest, cast(length(line) as bigint) as n_chars from (
      select unnest(string_split(html, chr(10))) as line from pages) l where line <> ''""",
}
