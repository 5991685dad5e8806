"""Entity matching and record merge."""

from pyspark.sql import functions as F

from checks import fixtures
from checks.index_queries import read
from sparkloom.functions import text as T
from sparkloom.operators import matching as M, merging as G, scale
from sparkloom.sources import readers, writers


def _sides(spark, sf_dir):
    return fixtures.left(spark, sf_dir), fixtures.right(spark, sf_dir).drop("r")


def _matches(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return M.match_entities(M.left_rows(left), M.right_rows(right))


def _merged(spark, sf_dir, matches=None):
    left, right = _sides(spark, sf_dir)
    facts = left.withColumn("meta", F.struct(F.concat(F.lit("u"), "key").alias("url")))
    return G.merge_records(facts, right, matches or _matches(spark, sf_dir))


def _both(spark, sf_dir):
    """Merged and right-only records from one run of the matcher."""
    matches = scale.cut_lineage(_matches(spark, sf_dir))
    return _merged(spark, sf_dir, matches), _rest(spark, sf_dir, matches)


def _flat(df):
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    return df.select(*[F.array_join(c, "|").alias(c) if c in arrays else c for c in df.columns])


def norm_text(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", T.norm_text(F.col("text")).alias("normal"), T.norm_text(F.col("text"), unicode=True).alias("normal_unicode"))


def base_names(spark, sf_dir):
    _, right = _sides(spark, sf_dir)
    return right.select("wiki_key", T.base_name(F.col("animal_name")).alias("base"), M.genus_species().alias("genus_species"))


def norm_array(spark, sf_dir):
    _, right = _sides(spark, sf_dir)
    pairs = F.explode(F.arrays_zip(F.col("animal_name_alternative").alias("raw"), T.norm_array(F.col("animal_name_alternative")).alias("normal")))
    return right.select("wiki_key", pairs.alias("p")).select("wiki_key", "p.raw", "p.normal")


def matcher_rows(spark, sf_dir):
    """Typed input of the matcher; missing lists are empty."""
    _, right = _sides(spark, sf_dir)
    return _flat(M.right_rows(right))


def match_entities(spark, sf_dir):
    return _matches(spark, sf_dir).select("key", "wiki_key", "match_type", "wiki_id")


def matched_name(spark, sf_dir):
    return _matches(spark, sf_dir).select("key", "matched_name")


def _people(spark, sf_dir):
    """Names shared by many records on both sides: word pairs of part names, brands and types."""
    parts = scale.dealt(read(spark, sf_dir, "part"))
    left = parts.select(
        F.col("p_partkey").cast("string").alias("key"),
        F.col("p_name").alias("common_name"),
        F.array("p_brand", "p_type").alias("common_name_alternative"),
        F.concat_ws(" ", "p_type", "p_brand").alias("scientific_name"),
    )
    right = parts.select(
        F.concat(F.lit("w"), "p_partkey").alias("wiki_key"),
        F.when(F.col("p_size") > 20, F.concat("p_name", F.lit(" (x)"))).otherwise(F.col("p_brand")).alias("animal_name"),
        F.when(F.col("p_size") > 40, F.array(F.upper("p_name"), F.col("p_type"))).alias("animal_name_alternative"),
        F.array(F.concat_ws(" ", "p_type", "p_brand")).alias("scientific_names"),
        (F.col("p_partkey") * 7 % 1000).alias("wiki_id"),
        F.col("p_type").alias("taxon"),
        F.col("p_type").alias("genus"),
        F.col("p_brand").alias("species"),
    )
    return left, right


def match_shared_names(spark, sf_dir):
    """Matching where a value has very many records on both sides."""
    left, right = _people(spark, sf_dir)
    return M.match_entities(left, right)


def merge_records(spark, sf_dir):
    return _flat(_merged(spark, sf_dir).withColumn("meta", F.col("meta.url")))


def merge_columns(spark, sf_dir):
    """Columns on both sides: equal and differing scalars, lists, a NULL side."""
    left, right = _sides(spark, sf_dir)
    shared = lambda df, a, b, c: df.withColumns({"status": a, "tags": b, "origin_id": c})
    lt = shared(left, F.when(F.length("key") > 2, F.lit("LC")), F.array("key", F.lit("both")), F.col("key"))
    rt = shared(right, F.when(F.col("wiki_id") % 4 < 2, F.lit("VU")), F.array(F.lit("both"), "wiki_key"), F.lit(None).cast("string"))
    merged = G.merge_records(lt, rt, _matches(spark, sf_dir))
    return _flat(merged.select("key", "status", "tags", "origin_id"))


def merge_kinds(spark, sf_dir):
    """Columns whose kinds differ between the sides, with NULLs on either side."""
    left, right = _sides(spark, sf_dir)
    odd, third = F.length("key") % 2 == 1, F.col("wiki_id") % 3 == 0
    lt = left.withColumns({"a": F.when(odd, F.array("key", F.lit("x"))), "b": F.when(odd, F.col("key")), "c": F.when(odd, F.struct("key")), "d": F.when(odd, F.array(F.length("key")))})
    rt = right.withColumns({"a": F.when(third, F.col("wiki_key")), "b": F.when(third, F.array("wiki_key")), "c": F.when(third, F.col("wiki_key")), "d": F.when(third, F.array("wiki_key"))})
    return _flat(G.merge_records(lt, rt, _matches(spark, sf_dir)).select("key", "a", "b", "c", "d"))


def _flat_meta(df):
    return _flat(df.withColumn("meta_wiki_id", F.col("meta.wiki_id")).drop("meta"))


def finished_records(spark, sf_dir):
    return _flat_meta(G.finish_merged(_merged(spark, sf_dir)))


def _rest(spark, sf_dir, matches=None):
    _, right = _sides(spark, sf_dir)
    return G.right_only(right, matches or _matches(spark, sf_dir))


def right_only(spark, sf_dir):
    return _flat_meta(_rest(spark, sf_dir))


def merged_union(spark, sf_dir):
    merged, rest = _both(spark, sf_dir)
    rows = G.merged_union(G.finish_merged(merged), rest)
    return rows.select("origin", "key", "common_name", "match_type", F.col("meta.wiki_id").alias("wiki_id"), "abstract")


def _union(spark, sf_dir):
    """Stored union of merged and right-only records with what the statistics count."""
    merged, rest = _both(spark, sf_dir)
    return scale.cut_lineage(G.merged_union(G.finish_merged(G.counted_flags(merged)), rest))


def match_stats(spark, sf_dir):
    return G.match_stats(_union(spark, sf_dir))


def match_type_counts(spark, sf_dir):
    return G.match_type_counts(_matches(spark, sf_dir))


def stats_round_trip(spark, sf_dir):
    """Statistics written as JSON and read back."""
    path = scale.scratch_path(spark, "stats")
    writers.write_stats(G.match_stats(_union(spark, sf_dir)), path)
    return readers.read_records(spark, path, "total_records bigint, matched_records bigint, right_only_records bigint")


QUERIES = {
    f.__name__: f
    for f in (
        norm_text,
        base_names,
        norm_array,
        matcher_rows,
        match_entities,
        matched_name,
        match_shared_names,
        merge_records,
        merge_columns,
        merge_kinds,
        finished_records,
        right_only,
        merged_union,
        match_stats,
        match_type_counts,
        stats_round_trip,
    )
}

FX = f"l as ({fixtures.for_duckdb(fixtures.LEFT)}), r as ({fixtures.for_duckdb(fixtures.RIGHT)})"

# Which rule a customer's right records obey follows from its key; the lower id wins.
MATCHED = """
m as (select cast(c_custkey as varchar) as key, nullif(c_custkey % 12, 0) as match_type,
  case when c_custkey % 12 > 0 then 'w' || c_custkey || '-0' end as wiki_key,
  case when c_custkey % 12 > 0 then c_custkey * 10 end as wiki_id,
  case c_custkey % 12 when 1 then c_name when 2 then upper(c_name) when 3 then c_name || ' (x)' when 4 then 'Alias ' || c_custkey
   when 5 then 'alias  ' || c_custkey when 6 then 'Alias ' || c_custkey
   when 9 then 'Genus' || c_custkey || ' species' || c_nationkey when 0 then null else 'Genus' || c_custkey || ' species' || c_nationkey end as matched_name
 from customer)
"""
_NORM = r"trim(lower(regexp_replace(regexp_replace({}, '[^\w\s]', '', 'g'), '\s+', ' ', 'g')))"
_NORM_U = r"trim(lower(regexp_replace(regexp_replace({}, '[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}\s]', '', 'g'), '\s+', ' ', 'g')))"

_N = _NORM.format
_PEOPLE = f"""
l as (select cast(p_partkey as varchar) as key, {_N('p_name')} as cn, [{_N('p_brand')}, {_N('p_type')}] as alts, {_N("p_type || ' ' || p_brand")} as sci from part),
r0 as (select 'w' || p_partkey as wiki_key, case when p_size > 20 then p_name || ' (x)' else p_brand end as animal_name,
  case when p_size > 20 then p_name else p_brand end as base, case when p_size > 40 then [upper(p_name), p_type] else [] end as walts,
  p_type || ' ' || p_brand as gs, p_type as taxon, p_partkey * 7 % 1000 as wiki_id from part),
r as (select *, {_N('animal_name')} as an, {_N('base')} as bn, list_transform(walts, lambda x: {_N('x')}) as wn, {_N('gs')} as gn, {_N('taxon')} as tn from r0),
rules as (
 select key, 1 as rule, wiki_id, wiki_key, animal_name as raw from l join r on cn = an
 union all select key, 2, wiki_id, wiki_key, walts[list_position(wn, cn)] from l join r on list_contains(wn, cn)
 union all select key, 3, wiki_id, wiki_key, animal_name from l join r on cn = bn
 union all select key, 4, wiki_id, wiki_key, animal_name from l join r on an = any(alts)
 union all select key, 5, wiki_id, wiki_key, case when wn[1] = any(alts) then walts[1] else walts[2] end from l join r on list_has_any(alts, wn)
 union all select key, 6, wiki_id, wiki_key, base from l join r on bn = any(alts)
 union all select key, 7, wiki_id, wiki_key, gs from l join r on sci = gn
 union all select key, 8, wiki_id, wiki_key, taxon from l join r on sci = tn),
ranked as (select *, row_number() over (partition by key order by rule, wiki_id, wiki_key) as n from rules)
"""

# The eleven rules over the names of both tables; nothing is known here of how the fixture was made.
_RULES = f"""
ln as (select key, 'common' as k, {_N('common_name')} as v from l union all select key, 'alternative', {_N('x')} from (select key, unnest(common_name_alternative) as x from l)
  union all select key, 'scientific', {_N('scientific_name')} from l),
rn as (select wiki_key, wiki_id, 'title' as k, {_N('animal_name')} as v from r union all select wiki_key, wiki_id, 'alternative', {_N('x')} from (select wiki_key, wiki_id, unnest(animal_name_alternative) as x from r)
  union all select wiki_key, wiki_id, 'base', {_N("string_split(animal_name, '(')[1]")} from r union all select wiki_key, wiki_id, 'scientific', {_N('x')} from (select wiki_key, wiki_id, unnest(scientific_names) as x from r)
  union all select wiki_key, wiki_id, 'taxon', {_N('taxon')} from r union all select wiki_key, wiki_id, 'pair', {_N("concat_ws(' ', genus, species)")} from r),
pairs as (select key, wiki_key, wiki_id, case ln.k || '-' || rn.k when 'common-title' then 1 when 'common-alternative' then 2 when 'common-base' then 3
   when 'alternative-title' then 4 when 'alternative-alternative' then 5 when 'alternative-base' then 6 when 'scientific-scientific' then 7 when 'scientific-taxon' then 8
   when 'scientific-pair' then 9 when 'scientific-title' then 10 when 'scientific-base' then 11 end as rule from ln join rn using (v) where v <> ''),
best as (select *, row_number() over (partition by key order by rule, wiki_id, wiki_key) as n from pairs where rule is not null)
"""

_ABSTRACT = "'About ' || c_name || ' & more ' || (c_custkey % 12) || ' Range Diet'"
_RIGHT_COLS = """animal_name, array_to_string(r.animal_name_alternative, '|') as animal_name_alternative, array_to_string(r.scientific_names, '|') as scientific_names,
 r.taxon, r.genus, r.species, r.abstract, array_to_string(r.text_sections, '|') as text_sections"""
_SCI = "'Genus' || c_custkey || ' species' || c_nationkey"
_FINISHED = f"""
f as (select m.key, m.wiki_key, c_name as common_name, m.match_type, r.species,
  case c_custkey % 12 when 2 then 'Alias ' || c_custkey || '|' || upper(c_name) when 5 then 'Alias ' || c_custkey || '|alias  ' || c_custkey else 'Alias ' || c_custkey end as common_name_alternative,
  {_SCI} as scientific_names, case when m.match_type is not null then {_ABSTRACT} end as abstract, m.wiki_id as meta_wiki_id, c_custkey
 from m join customer on m.key = cast(c_custkey as varchar) left join r on m.wiki_key = r.wiki_key)
"""
_REST = f"""
rest as (select r.wiki_key, r.species, {_ABSTRACT} as abstract, r.wiki_id as meta_wiki_id, r.animal_name as common_name,
  array_to_string(r.animal_name_alternative, '|') as common_name_alternative,
  case c_custkey % 12 when 7 then {_SCI} when 8 then {_SCI} when 9 then {_SCI} end as scientific_names,
  array_to_string(r.animal_name_alternative, '|') as animal_name_alternative
 from r join customer on r.wiki_id // 10 = c_custkey where r.wiki_key not in (select wiki_key from m where wiki_key is not null))
"""
_TYPES = ", ".join(f"count(*) filter (where match_type = {i}) as match_type_{i}" for i in range(1, 12))
_STATS = f"""select count(*) as total_records, count(match_type) as matched_records, count(*) filter (where match_type is null) as unmatched_records, {_TYPES},
 count(*) filter (where match_type is distinct from 7) as appended_scientific, count(*) filter (where match_type in (2, 5)) as alt_names_merged,
 count(match_type) + (select count(*) from rest) as with_meta_wiki_id, (select count(*) from rest) as right_only_records,
 count(match_type) / count(*) as match_rate from m"""
_LABELS = "case match_type " + " ".join(
    f"when {i} then '{label}'"
    for i, label in enumerate(
        (
            "common_name == animal_name",
            "common_name in wiki alternatives",
            "common_name == parenthetical base",
            "alt == animal_name",
            "alt lists overlap",
            "alt == animal_name_base",
            "scientific in list",
            "scientific == taxon",
            "scientific == genus+species",
            "scientific == animal_name",
            "scientific == animal_name_base",
        ),
        1,
    )
) + " end"

ORACLES = {
    "norm_text": f"select doc_id, {_N('text')} as normal, {_NORM_U.format('text')} as normal_unicode from documents",
    "base_names": f"""with {FX} select wiki_key, case when contains(animal_name, '(') then trim(string_split(animal_name, '(')[1]) else animal_name end as base,
      concat_ws(' ', genus, species) as genus_species from r""",
    "norm_array": f"with {FX}, raws as (select wiki_key, unnest(animal_name_alternative) as raw from r) select wiki_key, raw, {_N('raw')} as normal from raws",
    "matcher_rows": f"""with {FX} select wiki_key, animal_name, coalesce(array_to_string(animal_name_alternative, '|'), '') as animal_name_alternative,
      coalesce(array_to_string(scientific_names, '|'), '') as scientific_names, wiki_id, taxon, genus, species from r""",
    "match_entities": f"""with {FX}, {_RULES} select l.key, wiki_key, cast(rule as integer) as match_type, wiki_id from l left join best on best.key = l.key and n = 1""",
    "matched_name": f"with {MATCHED} select key, matched_name from m",
    "match_shared_names": f"""with {_PEOPLE} select l.key, wiki_key, raw as matched_name, rule as match_type, wiki_id
      from l left join ranked on l.key = ranked.key and n = 1""",
    "merge_records": f"""with {FX}, {MATCHED} select l.key, m.wiki_key, l.common_name, array_to_string(l.common_name_alternative, '|') as common_name_alternative,
      l.scientific_name, 'u' || l.key as meta, {_RIGHT_COLS}, m.matched_name, cast(m.match_type as integer) as match_type, m.wiki_id
      from l join m using (key) left join r on m.wiki_key = r.wiki_key""",
    "merge_columns": f"""with {MATCHED}, s as (select key, wiki_key, case when length(key) > 2 then 'LC' end as a, case when wiki_id % 4 < 2 then 'VU' end as b from m)
      select key, nullif(concat_ws('|', a, b), '') as status, key || '|both' || case when wiki_key is null then '' else '|' || wiki_key end as tags, key as origin_id from s""",
    "merge_kinds": f"""with {MATCHED}, s as (select key, length(key) % 2 = 1 as odd, case when wiki_id % 3 = 0 then wiki_key end as w from m)
      select key, case when odd then key || '|x' else w end as a, case when odd then key else w end as b, case when odd then '{{"key":"' || key || '"}}' else w end as c,
       case when odd and w is not null then length(key) || '|' || w when odd then cast(length(key) as varchar) else w end as d from s""",
    "finished_records": f"""with {FX}, {MATCHED}, {_FINISHED} select key, wiki_key, common_name, cast(match_type as integer) as match_type, species,
      common_name_alternative, scientific_names, abstract, meta_wiki_id from f""",
    "right_only": f"with {FX}, {MATCHED}, {_REST} select * from rest",
    "merged_union": f"""with {FX}, {MATCHED}, {_FINISHED}, {_REST}
      select 'merged' as origin, key, common_name, cast(match_type as integer) as match_type, meta_wiki_id as wiki_id, abstract from f
      union all select 'right_only', wiki_key, common_name, null, meta_wiki_id, abstract from rest""",
    "match_stats": f"with {FX}, {MATCHED}, {_REST} {_STATS}",
    "match_type_counts": f"with {MATCHED} select cast(match_type as integer) as match_type, {_LABELS} as label, count(*) as n_keys from m group by 1, 2",
    "stats_round_trip": f"with {FX}, {MATCHED}, {_REST} select total_records, matched_records, right_only_records from ({_STATS}) s",
}
