"""Postings, term statistics, leaves and tokenisers."""

from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import index as I, leaves as L
from sparkloom.operators.scale import dealt
from sparkloom.sources.readers import read_table


def read(spark, sf_dir, name):
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return read(spark, sf_dir, "documents")


def part_records(spark, sf_dir):
    """Parts as nested records: a scalar, a struct and a list."""
    p = dealt(read(spark, sf_dir, "part"))
    return p.select(
        F.col("p_partkey").alias("doc_id"),
        F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("Brand Name"), F.col("p_type").alias("type")).alias("make"),
        F.array("p_type", F.concat(F.lit("size "), "p_size")).alias("tags"),
        F.col("p_size").alias("id"),
    )


def part_tokens(spark, sf_dir):
    return I.tokens(L.record_leaves(part_records(spark, sf_dir), "doc_id"))


def doc_tokens(spark, sf_dir):
    return I.text_tokens(documents(spark, sf_dir))


def index_postings(spark, sf_dir):
    return I.postings(doc_tokens(spark, sf_dir))


def index_doc_freq(spark, sf_dir):
    return I.doc_freq(index_postings(spark, sf_dir))


def index_idf(spark, sf_dir):
    n_docs = I.collection_size(documents(spark, sf_dir))
    terms = I.build_index(doc_tokens(spark, sf_dir), n_docs).terms
    return terms.select("field", "term", "df", F.round("idf_standard", 6).alias("idf_standard"), F.round("idf_smooth", 6).alias("idf_smooth"))


def index_sorted(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = I.sorted_index(I.build_index(I.text_tokens(I.by_document(docs)), I.collection_size(docs)))
    return rows.select("field", "term", "doc_id", "tf", "df", F.round("idf_standard", 6).alias("idf_standard"))


def index_field_postings(spark, sf_dir):
    return I.postings(part_tokens(spark, sf_dir))


def json_leaves(spark, sf_dir):
    rows = L.json_leaves(read(spark, sf_dir, "events"), "event_id", "props")
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def record_leaves(spark, sf_dir):
    rows = L.record_leaves(part_records(spark, sf_dir), "doc_id")
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def json_field_postings(spark, sf_dir):
    return I.postings(I.tokens(L.json_leaves(read(spark, sf_dir, "events"), "event_id", "props")))


def json_record_leaves(spark, sf_dir):
    """Leaves of records that are known as JSON only; VARIANT orders keys by name."""
    parts = part_records(spark, sf_dir)
    rows = parts.select("doc_id", F.to_json(F.struct("id", "make", "name", "tags")).alias("record"))
    return L.json_leaves(rows, "doc_id", "record").select("doc_id", "path", "key", "value")


def collection_size(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.agg(F.count("*").alias("n_docs"), F.count_if(F.size(T.tokenize(F.col("text"))) == 0).alias("n_without_terms"))


def doc_universe(spark, sf_dir):
    return I.doc_universe(index_postings(spark, sf_dir))


def _mangled(spark, sf_dir):
    """Event records of which every seventh is cut short, and every eleventh missing."""
    text = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).when(F.col("event_id") % 11 != 0, F.col("props"))
    return read(spark, sf_dir, "events").select("event_id", text.alias("props"))


def json_leaves_malformed(spark, sf_dir):
    """Leaves where some records are no JSON: these have none."""
    return L.json_leaves(_mangled(spark, sf_dir), "event_id", "props").select("doc_id", "path", "value")


def malformed_json(spark, sf_dir):
    return L.malformed_json(_mangled(spark, sf_dir), "event_id", "props")


def clean_terms(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_terms(F.col("text")).alias("cleaned"))


def tokenize(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.array_join(T.tokenize(F.col("text")), " ").alias("terms"))


def analyze(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.array_join(T.analyze(F.col("text")), " ").alias("words"))


def format_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.format_key(F.col("url")).alias("url_key"))


def snippet(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.snippet(F.col("text")).alias("snippet"))


def stored_index(spark, sf_dir):
    """Index written by bucket and read back."""
    from sparkloom.operators.scale import scratch_path

    path = scratch_path(spark, "index")
    docs = documents(spark, sf_dir)
    I.write_index(I.postings(I.text_tokens(I.by_document(docs))), docs.count(), path, buckets=8)
    terms = I.read_index(spark, path).terms
    return terms.select("field", "term", "df", F.round("idf_standard", 6).alias("idf_standard"), F.round("idf_smooth", 6).alias("idf_smooth"))


QUERIES = {
    f.__name__: f
    for f in (
        index_postings,
        index_doc_freq,
        index_idf,
        index_sorted,
        index_field_postings,
        json_leaves,
        record_leaves,
        json_field_postings,
        json_record_leaves,
        json_leaves_malformed,
        malformed_json,
        collection_size,
        doc_universe,
        clean_terms,
        tokenize,
        analyze,
        format_key,
        snippet,
        stored_index,
    )
}

TERM = "'([a-z0-9]{2,}|[0-9])'"

DOC_POSTINGS = f"""
postings as (select '' as field, term, doc_id, count(*) as tf
 from (select doc_id, unnest(regexp_extract_all(lower(text), {TERM})) as term from documents) t group by term, doc_id)
"""

PART_LEAVES = """
leaves as (
 select p_partkey as doc_id, 0 as pos, 'name' as path, 'name' as key, p_name as value from part
 union all select p_partkey, 1, 'make.Brand Name', 'Brand Name', p_brand from part
 union all select p_partkey, 2, 'make.type', 'type', p_type from part
 union all select p_partkey, 3, 'tags', 'tags', p_type from part
 union all select p_partkey, 4, 'tags', 'tags', 'size ' || p_size from part
 union all select p_partkey, 5, 'id', 'id', cast(p_size as varchar) from part)
"""

LEAF_POSTINGS = f"""
leaf_terms as (select doc_id, trim(regexp_replace(lower(key), '[^a-z0-9]+', '_', 'g'), '_') as key, length(value) as n,
  unnest(regexp_extract_all(lower(value), {TERM})) as term from leaves),
postings as (select field, term, doc_id, count(*) as tf from (
  select '' as field, term, doc_id from leaf_terms union all
  select key, term, doc_id from leaf_terms where n <= 100 and key <> '') u group by field, term, doc_id)
"""

IDF = """
terms as (select field, term, count(*) as df, log10((select count(*) from DOCS) / count(*)) as idf_standard,
 log10((select count(*) from DOCS) / (1 + count(*))) + 1 as idf_smooth from postings group by field, term)
"""
DOC_TERMS = DOC_POSTINGS + "," + IDF.replace("DOCS", "documents")

EVENT_LEAVES = """
leaves as (select event_id as doc_id, 0 as pos, 'k' as path, 'k' as key, json_extract_string(props, '$.k') as value from events)
"""

# Words: join marks between letters (or digits) are put aside before the split; done twice, as matches share letters.
_JOINED = "text"
for _ in range(2):
    for _mark, _code in (("''", 57344), (".", 57345), (":", 57346), ("’", 57347), ("·", 57348)):
        _JOINED = f"regexp_replace({_JOINED}, '(\\p{{L}})[{_mark}](\\p{{L}})', '\\1' || chr({_code}) || '\\2', 'g')"
    for _mark, _code in (("''", 57344), (".", 57345), (",", 57349), (";", 57350), ("’", 57347)):
        _JOINED = f"regexp_replace({_JOINED}, '(\\p{{N}})[{_mark}](\\p{{N}})', '\\1' || chr({_code}) || '\\2', 'g')"
_WORDS = (
    f"array_to_string(regexp_extract_all(lower({_JOINED}), "
    "'[\\p{L}\\p{M}\\p{N}_' || chr(57344) || '-' || chr(57350) || ']+'), ' ')"
)
for _mark, _code in (("''", 57344), (".", 57345), (":", 57346), ("’", 57347), ("·", 57348), (",", 57349), (";", 57350)):
    _WORDS = f"replace({_WORDS}, chr({_code}), '{_mark}')"
WORDS = _WORDS

ORACLES = {
    "index_postings": f"with {DOC_POSTINGS} select * from postings",
    "index_doc_freq": f"with {DOC_POSTINGS} select field, term, count(*) as df from postings group by field, term",
    "index_idf": f"with {DOC_TERMS} select field, term, df, round(idf_standard, 6) as idf_standard, round(idf_smooth, 6) as idf_smooth from terms",
    "index_sorted": f"with {DOC_TERMS} select field, term, doc_id, tf, df, round(idf_standard, 6) as idf_standard from postings join terms using (field, term)",
    "index_field_postings": f"with {PART_LEAVES}, {LEAF_POSTINGS} select * from postings",
    "json_leaves": f"with {EVENT_LEAVES} select doc_id, cast(pos as bigint) as pos, path, key, value from leaves",
    "record_leaves": f"with {PART_LEAVES} select doc_id, cast(pos as bigint) as pos, path, key, value from leaves",
    "json_field_postings": f"with {EVENT_LEAVES}, {LEAF_POSTINGS} select * from postings",
    "json_record_leaves": f"with {PART_LEAVES} select doc_id, path, key, value from leaves",
    "json_leaves_malformed": f"with {EVENT_LEAVES} select doc_id, path, value from leaves where doc_id % 7 <> 0 and doc_id % 11 <> 0",
    "malformed_json": "select event_id as doc_id, left(props, length(props) - 1) as text from events where event_id % 7 = 0",
    "collection_size": f"select count(*) as n_docs, count(*) filter (where len(regexp_extract_all(lower(text), {TERM})) = 0) as n_without_terms from documents",
    "doc_universe": f"with {DOC_POSTINGS} select distinct doc_id from postings",
    "clean_terms": "select doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) as cleaned from documents",
    "tokenize": f"select doc_id, array_to_string(regexp_extract_all(lower(text), {TERM}), ' ') as terms from documents",
    "analyze": f"select doc_id, {WORDS} as words from documents",
    "format_key": "select page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') as url_key from pages",
    "snippet": "select doc_id, case when length(text) > 160 then replace(left(text, 157), chr(10), ' ') || '...' else replace(text, chr(10), ' ') end as snippet from documents",
    "stored_index": f"with {DOC_TERMS} select field, term, df, round(idf_standard, 6) as idf_standard, round(idf_smooth, 6) as idf_smooth from terms",
}
