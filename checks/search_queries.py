"""Boolean search with TF-IDF ranking, and multi-field search with BM25."""

from pyspark.sql import functions as F

from checks.index_queries import (
    DOC_TERMS,
    IDF,
    LEAF_POSTINGS,
    PART_LEAVES,
    TERM,
    doc_tokens,
    documents,
    part_records,
    part_tokens,
    read,
)
from sparkloom.functions import text as T
from sparkloom.operators import field_search as B, index as I, leaves as L, search as S
from sparkloom.operators.scale import scratch_path
from sparkloom.plans import jobs


def _matches(found):
    return found.select(
        "query_id", "doc_id", F.round("tfidf", 6).alias("tfidf"), F.round("tfidf_smooth", 6).alias("tfidf_smooth")
    )


def _search_docs(spark, sf_dir, exprs):
    queries = S.prepare(S.query_table(spark, exprs))
    n_docs = I.collection_size(documents(spark, sf_dir))
    return _matches(S.match_scores(S.index_for(doc_tokens(spark, sf_dir), n_docs, queries), queries))


def _search_parts(spark, sf_dir, exprs):
    queries = S.prepare(S.query_table(spark, exprs))
    n_docs = I.collection_size(read(spark, sf_dir, "part"))
    return _matches(S.match_scores(S.index_for(part_tokens(spark, sf_dir), n_docs, queries), queries))


def search_one_term(spark, sf_dir):
    return _search_docs(spark, sf_dir, {"q": S.term("blent")})


def search_and(spark, sf_dir):
    """Only the first token of a term counts."""
    return _search_docs(spark, sf_dir, {"q": S.term("the") & S.term("blent_concern")})


def search_and_or(spark, sf_dir):
    return _search_docs(spark, sf_dir, {"q": S.term("the") & (S.term("blent") | S.term("le"))})


def search_adjacent(spark, sf_dir):
    """Of terms side by side the first one selects and all rank; a missing operand voids the query."""
    exprs = {"adjacent": S.term("blent").then(S.term("the")), "void": S.term("the") & S.term("!"), "none": S.term("qqqq")}
    return _search_docs(spark, sf_dir, exprs)


def search_field(spark, sf_dir):
    return _search_parts(spark, sf_dir, {"q": S.field("Brand-Name", "17")})


def search_mixed(spark, sf_dir):
    exprs = {"q": S.term("ring") & (S.field("type", "economy") | S.field("type", "SMALL")), "r": S.all_of(S.term("red"), S.any_of(S.term("1"), S.term("2")))}
    return _search_parts(spark, sf_dir, exprs)


def boolean_search(spark, sf_dir):
    queries = S.prepare(S.query_table(spark, {"q": S.term("the") & (S.term("blent") | S.term("le"))}))
    n_docs = I.collection_size(documents(spark, sf_dir))
    return S.boolean_search(S.index_for(doc_tokens(spark, sf_dir), n_docs, queries), queries)


RANK_EXPRS = {"q1": S.term("the") & S.term("and"), "q2": S.term("le") | (S.term("the") & S.term("blent"))}


def rank_tfidf(spark, sf_dir):
    queries = S.prepare(S.query_table(spark, RANK_EXPRS))
    n_docs = I.collection_size(documents(spark, sf_dir))
    return S.rank_tfidf(S.index_for(doc_tokens(spark, sf_dir), n_docs, queries), queries)


def rank_tfidf_smooth(spark, sf_dir):
    queries = S.prepare(S.query_table(spark, RANK_EXPRS))
    n_docs = I.collection_size(documents(spark, sf_dir))
    return S.rank_tfidf_smooth(S.index_for(doc_tokens(spark, sf_dir), n_docs, queries), queries)


def item_queries(spark, sf_dir):
    """One query per benchmark item: any of its words."""
    words = F.array_distinct(T.tokenize(F.col("text")))
    ors = F.array_repeat(F.lit("||"), F.size("words") - 1)
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), words.alias("words"))
    return items.select("query_id", F.concat("words", ors).alias("expr"))


def query_terms(spark, sf_dir):
    """Normal form of raw terms: whole customer names, plain and as the value of a field."""
    names = read(spark, sf_dir, "customer")
    exprs = F.array("c_name", F.concat(F.lit("C Name:"), "c_name"), F.lit("&"), F.lit("seg:"), F.lit("||"), F.lit(":!"))
    queries = names.select(F.col("c_custkey").cast("string").alias("query_id"), exprs.alias("expr"))
    prepared = S.prepare_queries(queries)
    terms = F.array_join(F.transform("terms", lambda t: F.concat_ws("=", t["field"], t["term"])), " ")
    steps = F.array_join(F.transform("steps", lambda s: s.cast("string")), " ")
    return prepared.select("query_id", terms.alias("terms"), steps.alias("steps"), "valid", "shape")


def search_report(spark, sf_dir):
    """Number of matching documents per query next to its best document under both weights."""
    queries = S.prepare(S.query_table(spark, RANK_EXPRS))
    n_docs = I.collection_size(documents(spark, sf_dir))
    scores = _matches(S.match_scores(S.index_for(doc_tokens(spark, sf_dir), n_docs, queries), queries))
    best = lambda score: F.min_by("doc_id", F.struct(-F.col(score), F.col("doc_id")))
    return scores.groupBy("query_id").agg(
        F.count("*").alias("n_docs"), best("tfidf").alias("best"), best("tfidf_smooth").alias("best_smooth")
    )


def batch_topk(spark, sf_dir):
    queries = S.prepare(item_queries(spark, sf_dir))
    n_docs = I.collection_size(documents(spark, sf_dir))
    return S.rank_tfidf(S.index_for(doc_tokens(spark, sf_dir), n_docs, queries), queries, k=10)


def _stored_in_two(spark, sf_dir, buckets):
    """The index of all documents, written by two batches with their own numbers of buckets."""
    path = scratch_path(spark, "index")
    docs = documents(spark, sf_dir)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    for mode, kept, n in (("overwrite", english, buckets[0]), ("append", ~english, buckets[1])):
        some = docs.filter(kept)
        I.write_index(I.postings(I.text_tokens(I.by_document(some))), some.count(), path, mode, buckets=n)
    return I.read_index(spark, path)


def stored_index_search(spark, sf_dir):
    """Search in an index written by bucket and read back; the second batch appends the other languages."""
    return S.rank_tfidf(_stored_in_two(spark, sf_dir, (8, 8)), S.query_table(spark, RANK_EXPRS))


def stored_index_mixed_buckets(spark, sf_dir):
    """Whole statistics and a search where the second batch has another number of buckets."""
    return S.rank_tfidf(_stored_in_two(spark, sf_dir, (8, 5)), S.query_table(spark, RANK_EXPRS))


FIELD_QUERIES = (("f1", "red Widget"), ("f2", "Brand#17 economy SMALL small"), ("f3", "small ring"), ("f4", "size 7 bolt"))


def part_documents(spark, sf_dir):
    records = part_records(spark, sf_dir)
    return B.search_documents(records, F.col("name"), L.typed_leaves(records, ["make", "tags", "id"]))


def _queries(spark):
    return spark.createDataFrame(FIELD_QUERIES, "query_id string, text string")


def _index(spark, sf_dir, wanted):
    rows = B.field_documents(part_documents(spark, sf_dir))
    return B.field_index(rows, wanted.select("field", "term").distinct())


def field_documents(spark, sf_dir):
    rows = B.field_documents(part_documents(spark, sf_dir))
    return rows.select("doc_id", "field", F.array_join("tokens", " ").alias("tokens"))


def record_content(spark, sf_dir):
    return part_documents(spark, sf_dir).select("doc_id", "content")


def bm25_multi_field(spark, sf_dir):
    queries = _queries(spark)
    wanted = B.field_query_terms(queries)
    return B.field_scores(_index(spark, sf_dir, wanted), wanted).withColumn("score", F.round("score", 6))


def bm25_field_scoped(spark, sf_dir):
    """Terms of one named field only."""
    queries = spark.createDataFrame(
        [("s1", "economy", "make.type"), ("s2", "brand 17", "Brand Name"), ("s3", "7", "tags")],
        "query_id string, text string, field string",
    )
    wanted = B.field_query_terms(queries)
    return B.field_scores(_index(spark, sf_dir, wanted), wanted).withColumn("score", F.round("score", 6))


def bm25_content(spark, sf_dir):
    """Best messages of all conversations for every benchmark item, by content."""
    messages = read(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"), "text"
    )
    queries = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")
    rows = B.text_fields(messages, {B.CONTENT: F.col("text")})
    wanted = B.field_query_terms(queries, (B.CONTENT,))
    index = B.field_index(rows, wanted.select("field", "term").distinct())
    return B.search_fields(index, queries, (B.CONTENT,), k=5)


def bm25_stored(spark, sf_dir):
    """Multi-field search in a stored index."""
    path = scratch_path(spark, "fields")
    B.write_field_index(B.field_index(B.field_documents(part_documents(spark, sf_dir))), path, buckets=8)
    wanted = B.field_query_terms(_queries(spark))
    return B.field_scores(B.read_field_index(spark, path), wanted).withColumn("score", F.round("score", 6))


def bm25_null_query(spark, sf_dir):
    """Best parts for every part type and one query without text, in a stored index: the latter finds nothing."""
    path = scratch_path(spark, "fields")
    B.write_field_index(B.field_index(B.field_documents(part_documents(spark, sf_dir))), path, buckets=8)
    types = read(spark, sf_dir, "part").select(F.col("p_type").alias("query_id"), F.col("p_type").alias("text")).distinct()
    queries = types.unionByName(spark.createDataFrame([("none", None)], "query_id string, text string"))
    return B.search_fields(B.read_field_index(spark, path), queries, k=3)


def field_index_mixed_buckets(spark, sf_dir):
    """Multi-field search in an index stored by two batches with their own numbers of buckets."""
    path = scratch_path(spark, "fields")
    records = part_documents(spark, sf_dir)
    for mode, rest, n in (("overwrite", 0, 8), ("append", 1, 3)):
        some = B.field_documents(records.filter(F.pmod("doc_id", F.lit(2)) == rest))
        B.write_field_index(B.field_index(some), path, mode, n)
    wanted = B.field_query_terms(_queries(spark))
    return B.field_scores(B.read_field_index(spark, path), wanted).withColumn("score", F.round("score", 6))


def create_search_index(spark, sf_dir):
    """Records as JSON with their source, every ninth broken: the stored texts and the bad records."""
    path = scratch_path(spark, "search")
    parts = part_records(spark, sf_dir)
    text = F.to_json(F.struct("id", "make", "tags"))
    rows = parts.select(
        F.concat(F.lit("part "), "doc_id").alias("name"),
        F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("{"), text)).otherwise(text).alias("record"),
        F.concat(F.lit("file "), F.pmod("doc_id", F.lit(3))).alias("source"),
    )
    for mode, rest in (("overwrite", 0), ("append", 1)):
        jobs.create_search_index(rows.filter(F.pmod(F.length("name"), F.lit(2)) == rest), path, mode, 4)
    return _stored_records(spark, path)


def create_search_index_appended(spark, sf_dir):
    """Searchable documents after an append that dies before its commit and is repeated: each one once."""
    path = scratch_path(spark, "search")
    parts = part_records(spark, sf_dir)
    rows = parts.select(F.concat(F.lit("part "), "doc_id").alias("name"), F.to_json(F.struct("make", "tags")).alias("record"), F.lit("f").alias("source"))
    later = rows.filter(F.pmod(F.length("name"), F.lit(2)) == 1)
    jobs.create_search_index(rows.filter(F.pmod(F.length("name"), F.lit(2)) == 0), path, "overwrite", 4)
    # What such an append leaves behind: its documents, and no commit.
    half = later.select(F.col("name").alias("doc_id"), "name", F.lit("half").alias("content"), "source", F.lit("dead").alias("batch"))
    half.write.mode("append").partitionBy("batch").parquet(f"{path}/documents")
    index = jobs.create_search_index(later, path, "append", 4)
    found = index.postings.filter(F.col("field") == B.EXACT).select(F.col("term").alias("name"), "doc_id")
    return jobs.indexed_documents(spark, path).join(found, ["doc_id", "name"]).select("doc_id", "content", "source")


def _stored_records(spark, path):
    stored = jobs.indexed_documents(spark, path).select("doc_id", "content", "source", F.lit(True).alias("good"))
    bad = jobs.rejected_records(spark, path)
    return stored.unionByName(bad.select(F.col("name").alias("doc_id"), F.col("record").alias("content"), F.lit(None).cast("string").alias("source"), F.lit(False).alias("good")))


QUERIES = {
    f.__name__: f
    for f in (
        search_one_term,
        search_and,
        search_and_or,
        search_adjacent,
        search_field,
        search_mixed,
        boolean_search,
        rank_tfidf,
        rank_tfidf_smooth,
        query_terms,
        search_report,
        batch_topk,
        stored_index_search,
        stored_index_mixed_buckets,
        field_documents,
        record_content,
        bm25_multi_field,
        bm25_field_scoped,
        bm25_content,
        bm25_stored,
        field_index_mixed_buckets,
        create_search_index,
        create_search_index_appended,
        bm25_null_query,
    )
}

# Matches of one query: its terms, and the condition on the list of terms a document has.
_SCORES = """
scored as (select doc_id, list(field || ':' || term) as has, sum(tf * idf_standard) as tfidf, sum(tf * idf_smooth) as tfidf_smooth
 from postings join terms using (field, term) where field || ':' || term in (WANTED) group by doc_id)
"""


def _match_sql(base, query_id, wanted, condition, columns=True):
    scores = _SCORES.replace("WANTED", ", ".join(f"'{w}'" for w in wanted))
    kept = ", round(tfidf, 6) as tfidf, round(tfidf_smooth, 6) as tfidf_smooth" if columns else ""
    return f"(with {base}, {scores} select '{query_id}' as query_id, doc_id{kept} from scored where {condition})"


def _has(t):
    return f"list_contains(has, '{t}')"


def _rank_sql(score):
    parts = [
        _match_sql(DOC_TERMS, "q1", [":the", ":and"], f"{_has(':the')} and {_has(':and')}"),
        _match_sql(DOC_TERMS, "q2", [":le", ":the", ":blent"], f"{_has(':le')} or ({_has(':the')} and {_has(':blent')})"),
    ]
    return f"""select query_id, doc_id, {score} as score, cast(rank as integer) as rank from (
     select *, row_number() over (partition by query_id order by {score} desc, doc_id) as rank from ({' union all '.join(parts)}) m) r where rank <= 5"""


PART_TERMS = f"{PART_LEAVES}, {LEAF_POSTINGS}, {IDF.replace('DOCS', 'part')}"
_LE = f"{_has(':the')} and ({_has(':blent')} or {_has(':le')})"

# Fields of the part records. The name field also takes no leaf, as the name is no part of the record.
PART_FIELDS = r"""
leaf_fields as (
 select p_partkey as doc_id, unnest(['make.Brand Name', 'Brand Name']) as field, 1 as n, p_brand as value from part
 union all select p_partkey, unnest(['make.type', 'type']), 2, p_type from part
 union all select p_partkey, 'tags', 3, p_type from part
 union all select p_partkey, 'tags', 4, 'size ' || p_size from part
 union all select p_partkey, 'id', 5, cast(p_size as varchar) from part
 union all select p_partkey, 'name', 6, p_name from part
 union all select p_partkey, 'content', 7, concat_ws(chr(10), p_brand, p_type, p_type, 'size ' || p_size) from part),
fields as (select doc_id, field, list(t order by n, i) as tokens from (
  select doc_id, field, n, unnest(regexp_extract_all(lower(value), '[\p{L}\p{N}]+')) as t, generate_subscripts(regexp_extract_all(lower(value), '[\p{L}\p{N}]+'), 1) as i
  from leaf_fields) l group by doc_id, field
 union all select p_partkey, 'exact_name', [p_name] from part)
"""

_BM25 = """
postings as (select doc_id, field, dl, term, count(*) as tf from (select doc_id, field, len(tokens) as dl, unnest(tokens) as term from fields) t group by all),
stats as (select field, count(*) as n, sum(len(tokens)) as total from fields group by field),
dfs as (select field, term, count(*) as df from postings group by field, term),
lengths as (select distinct dl, case when dl < 24 then dl else 24 + ((dl - 24) // cast(pow(2, greatest(length(bin(dl - 24)) - 4, 0)) as bigint)) * cast(pow(2, greatest(length(bin(dl - 24)) - 4, 0)) as bigint) end as kept from postings),
scores as (select query_id, doc_id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * kept / (total / n)))), 6) as score
 from postings join wanted using (field, term) join dfs using (field, term) join stats using (field) join lengths using (dl) group by query_id, doc_id)
"""

_WANTED = r"""
texts as (select * from (values ('f1', 'red Widget'), ('f2', 'Brand#17 economy SMALL small'), ('f3', 'small ring'), ('f4', 'size 7 bolt')) v(query_id, text)),
words as (select query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) as term from texts),
wanted as (select query_id, field, term, count(*) as qtf from (
  select query_id, 'name' as field, term from words union all select query_id, 'content', term from words
  union all select query_id, 'exact_name', text from texts) w group by all)
"""
_TYPES = r"""
texts as (select distinct p_type as query_id, p_type as text from part union all select 'none', null),
words as (select query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) as term from texts),
wanted as (select query_id, field, term, count(*) as qtf from (
  select query_id, 'name' as field, term from words union all select query_id, 'content', term from words
  union all select query_id, 'exact_name', text from texts where text is not null) w group by all)
"""
_SCOPED = """
wanted as (select *, 1 as qtf from (values ('s1', 'make.type', 'economy'), ('s2', 'Brand Name', 'brand'), ('s2', 'Brand Name', '17'), ('s3', 'tags', '7')) v(query_id, field, term))
"""
_MESSAGES = r"""
fields as (select * from (select conv_id || '-' || turn as doc_id, 'content' as field, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as tokens from conversations) c where len(tokens) > 0),
wanted as (select cast(item_id as varchar) as query_id, 'content' as field, term, count(*) as qtf from (
  select item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) as term from benchmark) b group by all)
"""

_REPORT = " union all ".join(
    (
        _match_sql(DOC_TERMS, "q1", [":the", ":and"], f"{_has(':the')} and {_has(':and')}"),
        _match_sql(DOC_TERMS, "q2", [":le", ":the", ":blent"], f"{_has(':le')} or ({_has(':the')} and {_has(':blent')})"),
    )
)

ORACLES = {
    "query_terms": f"""with t as (select cast(c_custkey as varchar) as query_id, regexp_extract(lower(c_name), {TERM}) as t from customer)
      select query_id, '=' || t || ' c_name=' || t || ' =seg' as terms, '0 1 -1 2 -2' as steps, true as valid, 'mixed' as shape from t""",
    "search_report": f"""with m as ({_REPORT}) select query_id, count(*) as n_docs, first(doc_id order by tfidf desc, doc_id) as best,
      first(doc_id order by tfidf_smooth desc, doc_id) as best_smooth from m group by query_id""",
    "search_one_term": _match_sql(DOC_TERMS, "q", [":blent"], "true"),
    "search_and": _match_sql(DOC_TERMS, "q", [":the", ":blent"], f"{_has(':the')} and {_has(':blent')}"),
    "search_and_or": _match_sql(DOC_TERMS, "q", [":the", ":blent", ":le"], _LE),
    "search_adjacent": _match_sql(DOC_TERMS, "adjacent", [":blent", ":the"], _has(":blent")),
    "search_field": _match_sql(PART_TERMS, "q", ["brand_name:17"], "true"),
    "search_mixed": _match_sql(PART_TERMS, "q", [":ring", "type:economy", "type:small"], f"{_has(':ring')} and ({_has('type:economy')} or {_has('type:small')})")
    + " union all "
    + _match_sql(PART_TERMS, "r", [":red", ":1", ":2"], f"{_has(':red')} and ({_has(':1')} or {_has(':2')})"),
    "boolean_search": _match_sql(DOC_TERMS, "q", [":the", ":blent", ":le"], _LE, columns=False),
    "rank_tfidf": _rank_sql("tfidf"),
    "rank_tfidf_smooth": _rank_sql("tfidf_smooth"),
    "batch_topk": f"""with {DOC_TERMS},
     wanted as (select distinct cast(item_id as varchar) as query_id, unnest(regexp_extract_all(lower(text), {TERM})) as term from benchmark),
     scores as (select query_id, doc_id, round(sum(tf * idf_standard), 6) as score from postings join terms using (field, term) join wanted using (term) group by query_id, doc_id)
     select query_id, doc_id, score, cast(rank as integer) as rank from (select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from scores) r where rank <= 10""",
    "stored_index_search": _rank_sql("tfidf"),
    "stored_index_mixed_buckets": _rank_sql("tfidf"),
    "field_index_mixed_buckets": f"with {PART_FIELDS}, {_WANTED}, {_BM25} select * from scores",
    "create_search_index": """with p as (select 'part ' || p_partkey as name, p_partkey % 9 = 0 as bad, 'file ' || (p_partkey % 3) as source,
        concat_ws(chr(10), p_brand, p_type, p_type, 'size ' || p_size) as content,
        '{{"id":' || p_size || ',"make":{"Brand Name":' || to_json(p_brand) || ',"type":' || to_json(p_type) || '},"tags":[' || to_json(p_type) || ',' || to_json('size ' || p_size) || ']}' as broken from part)
      select name as doc_id, case when bad then broken else content end as content, case when not bad then source end as source, not bad as good from p""",
    "create_search_index_appended": "select 'part ' || p_partkey as doc_id, concat_ws(chr(10), p_brand, p_type, p_type, 'size ' || p_size) as content, 'f' as source from part",
    "bm25_null_query": f"""with {PART_FIELDS}, {_TYPES}, {_BM25} select query_id, doc_id, score, cast(rank as integer) as rank from (
     select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from scores) r where rank <= 3""",
    "field_documents": f"with {PART_FIELDS} select doc_id, field, array_to_string(tokens, ' ') as tokens from fields",
    "record_content": "select p_partkey as doc_id, concat_ws(chr(10), p_brand, p_type, p_type, 'size ' || p_size) as content from part",
    "bm25_multi_field": f"with {PART_FIELDS}, {_WANTED}, {_BM25} select * from scores",
    "bm25_field_scoped": f"with {PART_FIELDS}, {_SCOPED}, {_BM25} select * from scores",
    "bm25_content": f"""with {_MESSAGES}, {_BM25} select query_id, doc_id, score, cast(rank as integer) as rank from (
     select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from scores) r where rank <= 5""",
    "bm25_stored": f"with {PART_FIELDS}, {_WANTED}, {_BM25} select * from scores",
}
