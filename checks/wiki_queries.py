"""Wikitext stages, wiki records, dump files."""

from pyspark.sql import functions as F

from checks import fixtures
from checks.index_queries import read
from sparkloom.functions import wikitext as W
from sparkloom.operators import wiki as R
from sparkloom.operators.scale import scratch_path
from sparkloom.sources import readers, writers

wiki = fixtures.wiki


def _boxes(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", W.template_block(F.col("text")).alias("box"))


def template_filter(spark, sf_dir):
    return R.pages_with_template(wiki(spark, sf_dir)).select("wiki_id")


def filter_report(spark, sf_dir):
    return R.filter_report(wiki(spark, sf_dir))


def template_block(spark, sf_dir):
    return _boxes(spark, sf_dir).select(
        "wiki_id", F.col("box.block").alias("block"), F.length("box.after").cast("bigint").alias("n_after")
    )


def template_field(spark, sf_dir):
    block = F.col("box.block")
    names = ("status", "genus", "species", "taxon", "synonyms_ref", "range")
    return _boxes(spark, sf_dir).select("wiki_id", *[W.template_field(block, n).alias(n) for n in names])


def scientific_names(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", F.array_join(W.scientific_names(F.col("text")), "|").alias("names"))


def synonyms(spark, sf_dir):
    return _boxes(spark, sf_dir).select("wiki_id", F.array_join(W.synonyms(F.col("box.block")), "|").alias("names"))


def redirect_titles(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", F.array_join(W.redirect_titles(F.col("text")), "|").alias("titles"))


def remove_file_links(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", W.remove_file_links(F.col("text")).alias("cleaned"))


def link_text(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", W.link_text(F.col("text")).alias("cleaned"))


def strip_templates(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", W.strip_templates(F.col("text")).alias("cleaned"))


def strip_refs_and_tags(spark, sf_dir):
    """Whole HTML pages, which hold every kind of tag."""
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", W.strip_refs_and_tags(F.col("html")).alias("cleaned"))


def clean_wikitext(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", W.clean_wikitext(F.col("text")).alias("cleaned"))


def abstract_headings(spark, sf_dir):
    body = F.coalesce(F.col("box.after"), F.col("text"))
    rows = wiki(spark, sf_dir).withColumn("box", W.template_block(F.col("text")))
    return rows.select("wiki_id", W.abstract(body).alias("abstract"), F.array_join(W.headings(body), "|").alias("headings"))


def categories(spark, sf_dir):
    return wiki(spark, sf_dir).select("wiki_id", F.array_join(W.categories(F.col("text")), "|").alias("categories"))


def _flat(df):
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    return df.select(*[F.array_join(c, "|").alias(c) if c in arrays else c for c in df.columns])


def wiki_records(spark, sf_dir):
    return _flat(R.extract_wiki_records(wiki(spark, sf_dir)).drop("chunk"))


def wiki_record_kinds(spark, sf_dir):
    """Records of pages that differ in kind; those without a title have none."""
    records = _flat(R.extract_wiki_records(fixtures.wiki_kinds(spark, sf_dir).drop("kind", "chunk")))
    return records.select("wiki_id", "animal_name", "genus", "species", "scientific_names", "abstract", "text_sections")


def filter_report_kinds(spark, sf_dir):
    """Counts per file with pages that have no title or no text."""
    return R.filter_report(fixtures.wiki_kinds(spark, sf_dir))


def wiki_mapping(spark, sf_dir):
    """Records that share a name: every title is used by all documents of one source and language."""
    docs = read(spark, sf_dir, "documents")
    named = docs.select(F.col("doc_id").alias("wiki_id"), F.concat_ws(" ", "lang", "source").alias("animal_name"))
    lists = named.withColumn("categories", F.when(F.col("wiki_id") % 2 == 0, F.array(F.lit("even"))).otherwise(F.array().cast("array<string>")))
    return _flat(R.records_by_name(lists))


def wiki_dedupe(spark, sf_dir):
    """Pages of which all copies but one go: ids repeat per order, some ids are missing."""
    lines = read(spark, sf_dir, "lineitem")
    pages = lines.select(
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("wiki_id"),
        F.concat(F.lit("Order "), "l_orderkey").alias("title"),
        F.concat_ws("/", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("text"),
        F.concat(F.lit("chunk_"), "l_linenumber").alias("chunk"),
    )
    return R.dedupe_pages(pages)


def chunk_order(spark, sf_dir):
    """Files with their number, by which they sort instead of by name."""
    files = wiki(spark, sf_dir).select(F.regexp_replace("chunk", r"\.xml$", "_filtered.xml").alias("chunk")).distinct()
    return files.withColumn("chunk_no", readers.chunk_number(F.col("chunk")))


def _whole_pages(spark, sf_dir):
    """Fixture pages as an export has them: two revisions, contributor, time; every tenth without a title."""
    rows = wiki(spark, sf_dir)
    number = F.col("wiki_id")

    def revision(add, text):
        who = F.struct(F.lit(None).cast("string").alias("_deleted"), F.concat(F.lit("user "), number % 5).alias("username"), (number % 5).alias("id"), F.lit(None).cast("string").alias("ip"))
        parts = {"id": number * 10 + add, "timestamp": F.concat(F.lit("2024-01-0"), number % 9 + 1, F.lit("T00:00:00Z")), "contributor": who, "text": F.struct(text.alias("_VALUE"))}
        return F.struct(*[c.alias(n) for n, c in parts.items()])

    title = F.when(number % 10 != 0, F.col("title"))
    page = F.struct(title.alias("title"), (number % 3).alias("ns"), number.alias("id"), F.array(revision(1, F.col("text")), revision(0, F.lit("older"))).alias("revision"))
    return rows.withColumns({"title": title, "page": page})


def dump_round_trip(spark, sf_dir):
    """Pages with a box written whole as XML chunks, read back in chunk order, then extracted; pages without title are dropped only here."""
    path = scratch_path(spark, "chunks")
    writers.write_filtered_pages(R.pages_with_template(_whole_pages(spark, sf_dir)), path)
    pages = readers.read_filtered_chunks(spark, path)
    return _flat(R.extract_wiki_records(pages).select("chunk", "chunk_no", "wiki_id", "animal_name", "genus", "abstract", "categories"))


def whole_pages_round_trip(spark, sf_dir):
    """Everything of filtered and merged pages: namespace, revisions, times, contributors, pages without title."""
    first, second = scratch_path(spark, "chunks"), scratch_path(spark, "merged")
    writers.write_filtered_pages(R.pages_with_template(_whole_pages(spark, sf_dir)), first)
    writers.write_merged_chunks(readers.read_filtered_chunks(spark, first), second)
    p = readers.read_dump_pages(spark, second).select("wiki_id", "text", "page.*")
    revisions = F.array_join(F.transform("revision", lambda r: F.concat_ws(" ", r["id"], r["timestamp"], r["contributor"]["username"], r["contributor"]["id"])), "|")
    last = F.element_at("revision", -1)["text"]["_VALUE"].alias("last_text")
    return p.select("wiki_id", "title", "ns", "id", revisions.alias("revisions"), F.md5("text").alias("text"), last)


def merged_chunks(spark, sf_dir):
    """All pages of all chunks written as one data set and counted again."""
    path = scratch_path(spark, "merged")
    pages = wiki(spark, sf_dir).withColumn("chunk_no", F.regexp_extract("chunk", r"(\d+)", 1).cast("bigint"))
    writers.write_merged_chunks(pages, path)
    return readers.read_dump_pages(spark, path).select("wiki_id", "title", "text")


def merge_summary(spark, sf_dir):
    return writers.merge_summary(R.pages_with_template(wiki(spark, sf_dir)))


def records_round_trip(spark, sf_dir):
    """Wiki records written as JSON without NULL fields and read back."""
    path = scratch_path(spark, "records")
    records = R.records_by_name(R.extract_wiki_records(wiki(spark, sf_dir)))
    writers.write_keyed_records(records.drop("chunk"), path)
    back = readers.read_records(spark, path, "wiki_id bigint, animal_name string, genus string, categories array<string>")
    return _flat(back)


def key_records(spark, sf_dir):
    """Records keyed by the first usable of the left candidates; of equal keys the last record stays."""
    events = read(spark, sf_dir, "events")
    rows = events.select(
        F.col("event_id").alias("i"),
        F.when(F.col("user_id") % 3 == 0, F.lit("")).when(F.col("user_id") % 3 == 1, F.concat(F.lit("u"), "user_id")).alias("common_name"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("name"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("k"), "user_id")).alias("key"),
    )
    return R.key_records(rows, "i", *R.left_key_candidates(rows)).select("key", "i")


def key_right_records(spark, sf_dir):
    """The right candidates, with a column missing."""
    parts = read(spark, sf_dir, "part")
    rows = parts.select(
        F.col("p_partkey").alias("i"),
        F.when(F.col("p_size") % 4 == 0, F.col("p_name")).alias("animal_name"),
        F.when(F.col("p_size") % 4 != 3, F.col("p_type")).alias("genus"),
        F.when(F.col("p_size") % 4 == 1, F.col("p_brand")).otherwise("").alias("species"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_partkey")).alias("wiki_id"),
    )
    return R.key_records(rows, "i", *R.right_key_candidates(rows)).select("key", "i")


QUERIES = {
    f.__name__: f
    for f in (
        template_filter,
        filter_report,
        template_block,
        template_field,
        scientific_names,
        synonyms,
        redirect_titles,
        remove_file_links,
        link_text,
        strip_templates,
        strip_refs_and_tags,
        clean_wikitext,
        abstract_headings,
        categories,
        wiki_records,
        wiki_record_kinds,
        filter_report_kinds,
        wiki_mapping,
        wiki_dedupe,
        chunk_order,
        dump_round_trip,
        whole_pages_round_trip,
        merged_chunks,
        merge_summary,
        records_round_trip,
        key_records,
        key_right_records,
    )
}

KINDS = f"k as (select f.*, d.lang, d.source from ({fixtures.for_duckdb(fixtures.WIKI_KINDS)}) f join documents d on d.doc_id = f.wiki_id)"
FX = f"fx as ({fixtures.for_duckdb(fixtures.WIKI)})"

# Boxes of the fixture are nested two deep at most.
BLOCK = r"nullif(regexp_extract(text, '(?i)\{\{\s*speciesbox(?:[^{}]|\{\{[^{}]*\}\})*\}\}'), '')"
BOX = f"boxed as (select *, {BLOCK} as block, case when {BLOCK} is null then text else substr(text, instr(text, {BLOCK}) + length({BLOCK})) end as body from fx)"


def _field(name):
    value = rf"regexp_extract(block, '(?m)^\|[ \t]*{name}[ \t]*=(.*)$', 1)"
    return f"nullif(trim(trim(regexp_replace({value}, '<!--.*?-->', '', 'g')), chr(34) || chr(39)), '')"


def _strip(col):
    return f"trim({col}, ' ' || chr(9) || chr(10) || chr(13))"


def _no_templates(col):
    for _ in range(3):
        col = rf"regexp_replace({col}, '\{{\{{[^{{}}]*\}}\}}', '', 'g')"
    return col


def _no_refs(col):
    for p in (r"(?i)<ref[^>]*?/\s*>", "(?is)<ref[^>]*?>.*?</ref>", "<[^>]+>"):
        col = f"regexp_replace({col}, '{p}', '', 'g')"
    return col


def _links(col):
    piped = rf"regexp_replace({col}, '\[\[[^\]|]+\|([^\]]+)\]\]', '\1', 'g')"
    return rf"regexp_replace({piped}, '\[\[([^\]]+)\]\]', '\1', 'g')"


NO_FILES = r"regexp_replace({}, '(?i)\[\[(?:File|Image):[^\]]+\]\]', '', 'g')"


def _clean(col):
    col = rf"regexp_replace({col}, '(?i)\[\[Category:[^\]]+\]\]', '', 'g')"
    col = _links(_no_templates(_no_refs(NO_FILES.format(col))))
    col = rf"regexp_replace(regexp_replace({col}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
    return _strip(col)


# The first level-2 heading of every fixture page is "Range"; the last two categories close the page.
ABSTRACT = _clean("string_split(body, chr(10) || '== Range ==')[1]")
HEADINGS = "'Range|Diet' || source"
CATEGORIES = "lang || ' animals|All'"
TITLES = "'Old ' || wiki_id || '|Label ' || lang"
# The listed name counts only where the title before it names synonyms; the reference comes first.
SYNONYMS = r"""regexp_extract(block, 'synonyms_ref = \{\{cite\|title=([^}]+)\}\}', 1)
 || case when regexp_matches(block, '(?m)^\| title = \[\[Synonym') then '|' || regexp_extract(block, '(?m)^\|''''([^'']+)'''' L', 1) else '' end"""
NAMES = f"{SYNONYMS} || '|Panthera leo and|Felis catus|Panthera leo|Genus ' || lang"
FX_DOCS = f"{FX}, {BOX}, docs as (select b.*, d.lang, d.source from boxed b join documents d on b.wiki_id = d.doc_id)"
RECORD = f"""wiki_id, trim(title) as animal_name, {_field('status')} as status, {_field('genus')} as genus, {_field('species')} as species,
 {_field('taxon')} as taxon, case when block is null then '' else {NAMES} end as scientific_names, {TITLES} as animal_name_alternative,
 {ABSTRACT} as abstract, {HEADINGS} as text_sections, {CATEGORIES} as categories"""

# Names in a whole text: in title values, then in italics.
_BIN = r"'\b([A-Z][a-z]+\s+[a-z][a-z\-]+(?:\s+[a-z][a-z\-]+)?)\b'"
TEXT_NAMES = f"""
parts as (select wiki_id, list_concat(
   list_transform(regexp_extract_all(text, '(?i)\\btitle\\s*=\\s*([^|{{}}\\n\\r]+)', 1), lambda t: replace(trim(trim(t), chr(39) || chr(34)), $$''$$, '')),
   regexp_extract_all(text, '''''+([^'']{{1,200}})''''+', 1)) as parts from fx),
found as (select wiki_id, unnest(flatten(list_transform(parts, lambda p: regexp_extract_all(p, {_BIN}, 1)))) as name,
   generate_subscripts(flatten(list_transform(parts, lambda p: regexp_extract_all(p, {_BIN}, 1))), 1) as i from parts),
firsts as (select wiki_id, name, min(i) as i from found group by all)
"""

ORACLES = {
    "template_filter": rf"with {FX} select wiki_id from fx where regexp_matches(text, '(?i)\{{\{{\s*speciesbox')",
    "filter_report": rf"""with {FX} select chunk, count(*) as total_pages, count(*) filter (where regexp_matches(text, '(?i)\{{\{{\s*speciesbox')) as matched_pages,
      count(*) filter (where regexp_matches(text, '(?i)\{{\{{\s*speciesbox')) > 0 as has_output from fx group by rollup (chunk)""",
    "template_block": f"with {FX}, {BOX} select wiki_id, block, case when block is not null then cast(length(body) as bigint) end as n_after from boxed",
    "template_field": f"with {FX}, {BOX} select wiki_id, "
    + ", ".join(f'{_field(n)} as "{n}"' for n in ("status", "genus", "species", "taxon", "synonyms_ref", "range"))
    + " from boxed",
    "scientific_names": f"""with {FX}, {TEXT_NAMES} select wiki_id, coalesce(names, '') as names from fx left join (
      select wiki_id, string_agg(name, '|' order by i) as names from firsts group by wiki_id) n using (wiki_id)""",
    "synonyms": f"with {FX}, {BOX} select wiki_id, case when block is not null then {SYNONYMS} else '' end as names from boxed",
    "redirect_titles": f"with {FX_DOCS} select wiki_id, {TITLES} as titles from docs",
    "remove_file_links": f"with {FX} select wiki_id, {NO_FILES.format('text')} as cleaned from fx",
    "link_text": f"with {FX} select wiki_id, {_links('text')} as cleaned from fx",
    "strip_templates": f"with {FX} select wiki_id, {_no_templates('text')} as cleaned from fx",
    "strip_refs_and_tags": f"select page_id, {_no_refs('html')} as cleaned from pages",
    "clean_wikitext": f"with {FX} select wiki_id, {_clean('text')} as cleaned from fx",
    "abstract_headings": f"with {FX_DOCS} select wiki_id, {ABSTRACT} as abstract, {HEADINGS} as headings from docs",
    "categories": f"with {FX_DOCS} select wiki_id, {CATEGORIES} as categories from docs",
    "wiki_records": f"with {FX_DOCS} select {RECORD} from docs",
    "wiki_record_kinds": f"""with {KINDS} select wiki_id, title as animal_name,
      case kind when 0 then 'G' || wiki_id when 2 then lang end as genus, case kind when 6 then 's' end as species, case when kind <> 3 then '' end as scientific_names,
      case kind when 0 then 'Body ' || lang || '.' when 1 then '{{{{Speciesbox' || chr(10) || '| genus = Open' || chr(10) || '| ref = Body ' || lang || '.' when 2 then 'After ' || lang || '.'
       when 5 then 'No box ' || lang when 6 then 'late' end as abstract,
      case kind when 3 then null when 5 then 'One|Two' when 6 then source else '' end as text_sections from k where title is not null""",
    "filter_report_kinds": f"""with {KINDS} select chunk, count(*) as total_pages, count(*) filter (where kind not in (3, 5)) as matched_pages,
      count(*) filter (where kind not in (3, 5)) > 0 as has_output from k group by rollup (chunk)""",
    "wiki_mapping": """select max(doc_id) as wiki_id, lang || ' ' || source as animal_name,
      case when max(doc_id) % 2 = 0 then 'even' end as categories from documents group by lang, source""",
    "wiki_dedupe": """with pages as (select case when l_orderkey % 5 <> 0 then l_orderkey end as wiki_id, 'Order ' || l_orderkey as title,
        l_linenumber || '/' || l_partkey as text, 'chunk_' || l_linenumber as chunk from lineitem),
      ranked as (select *, row_number() over (partition by wiki_id, case when wiki_id is null then title end order by chunk, title, text) as n from pages)
      select wiki_id, title, text, chunk from ranked where n = 1""",
    "chunk_order": """select 'chunk_' || n || '_filtered.xml' as chunk, n as chunk_no
      from (select distinct doc_id % 12 as n from documents) d""",
    "dump_round_trip": f"""with {FX_DOCS} select replace(chunk, '.xml', '_filtered.xml') as chunk, wiki_id % 12 as chunk_no, wiki_id, title as animal_name,
      {_field('genus')} as genus, {ABSTRACT} as abstract, {CATEGORIES} as categories from docs where block is not null and wiki_id % 10 <> 0""",
    "whole_pages_round_trip": f"""with {FX_DOCS}, v as (select *, '2024-01-0' || (wiki_id % 9 + 1) || 'T00:00:00Z user ' || (wiki_id % 5) || ' ' || (wiki_id % 5) as rest from docs where block is not null)
      select wiki_id, case when wiki_id % 10 <> 0 then title end as title, wiki_id % 3 as ns, wiki_id as id,
       (wiki_id * 10 + 1) || ' ' || rest || '|' || (wiki_id * 10) || ' ' || rest as revisions, md5(text) as text, 'older' as last_text from v""",
    "merged_chunks": f"with {FX} select wiki_id, title, text from fx",
    "merge_summary": rf"with {FX} select count(*) as total_pages, count(distinct chunk) as files_merged from fx where regexp_matches(text, '(?i)\{{\{{\s*speciesbox')",
    "records_round_trip": f"with {FX_DOCS} select wiki_id, title as animal_name, {_field('genus')} as genus, {CATEGORIES} as categories from docs",
    "key_records": """with keyed as (select event_id as i, coalesce(case when user_id % 3 = 1 then 'u' || user_id end,
        case when event_id % 2 = 0 then nullif(event_type, '') end, case when event_id % 5 = 0 then 'k' || user_id end, 'row_' || event_id) as key from events)
      select key, max(i) as i from keyed group by key""",
    "key_right_records": """with keyed as (select p_partkey as i, coalesce(case when p_size % 4 = 0 then nullif(p_name, '') end,
        case when p_size % 4 = 1 then p_type || ' ' || p_brand end, case when p_size % 3 = 0 then cast(p_partkey as varchar) end, 'row_' || p_partkey) as key from part)
      select key, max(i) as i from keyed group by key""",
}
