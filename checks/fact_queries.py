"""Facts records from HTML pages."""

from pyspark.sql import functions as F

from checks import fixtures
from checks.index_queries import read
from sparkloom.functions import html as H, text as T
from sparkloom.operators import facts as X


def _flat(df, columns):
    """Lists joined by ``|``, so both engines compare plain text."""
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    return df.select(*[F.array_join(c, "|").alias(c) if c in arrays else c for c in columns])


FIELDS = ("kingdom", "class", "order", "habitat", "height", "type", "prey", "fun_facts", "other_names", "phylum")


def facts_fields(spark, sf_dir):
    return X.fact_fields(fixtures.html(spark, sf_dir)).select("page_id", *FIELDS)


def facts_lists(spark, sf_dir):
    pages = X.fact_fields(fixtures.html(spark, sf_dir))
    return pages.select(
        "page_id",
        F.array_join(H.items_or_text(F.col("color")), "|").alias("color"),
        F.array_join(H.items_or_text(F.col("group_behavior")), "|").alias("group_behavior"),
        F.array_join(X.location_list(F.col("html")), "|").alias("locations"),
    )


def facts_names(spark, sf_dir):
    html = F.col("html")
    return fixtures.html(spark, sf_dir).select(
        "page_id",
        H.title_header(html).alias("common_name"),
        H.headline(html).alias("headline"),
        H.title_scientific_name(html).alias("scientific_name"),
    )


def facts_sections(spark, sf_dir):
    sections = F.explode(H.text_sections(F.col("html"))).alias("s")
    return fixtures.html(spark, sf_dir).select("page_id", sections).select("page_id", "s.header", "s.text")


def facts_alt_names(spark, sf_dir):
    pages = X.fact_fields(fixtures.html(spark, sf_dir))
    names = X.alternative_names(H.headline(F.col("html")), F.col("other_names"))
    return pages.select("page_id", F.array_join(names, "|").alias("names"))


def iucn_code(spark, sf_dir):
    return fixtures.html(spark, sf_dir).select("page_id", X.conservation_status(F.col("html")).alias("status"))


def conservation_code(spark, sf_dir):
    """Any text as a status: whole documents, of which few hold a known phrase."""
    docs = read(spark, sf_dir, "documents")
    near = F.concat(F.lit("Critically ENDANGERED or "), "text")
    col = F.when(F.col("doc_id") % 2 == 0, near).otherwise(F.col("text"))
    return docs.select("doc_id", T.conservation_code(col).alias("status"))


def _records(df):
    get = lambda group, *names: [F.col(group)[n].alias(n) for n in names]
    descriptions = F.array_sort(F.transform(F.map_entries("descriptions"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    flat = df.select(
        "page_id",
        "common_name",
        "common_name_alternative",
        "scientific_name",
        *get("taxonomy", "kingdom", "class", "order"),
        F.col("behavior").isNull().alias("no_behavior"),
        *get("physical_characteristics", "height", "type"),
        "physical_color",
        "group_behavior",
        *get("biological_facts", "prey"),
        "locations_range",
        *get("habitat_distribution", "habitat"),
        *get("conservation", "conservation_status"),
        descriptions.alias("descriptions"),
        "fun_facts",
        *get("meta", "url", "source_file"),
    )
    return _flat(flat, flat.columns)


def facts_record(spark, sf_dir):
    return _records(X.extract_facts(fixtures.html(spark, sf_dir)))


def facts_dataset(spark, sf_dir):
    return _records(X.facts_dataset(X.extract_facts(fixtures.html(spark, sf_dir))))


def facts_of_pages(spark, sf_dir):
    """Given pages have no facts: empty parts are NULL, the headline is the only name."""
    pages = read(spark, sf_dir, "pages")
    facts = X.extract_facts(pages)
    return facts.select(
        "page_id",
        "common_name",
        F.array_join("common_name_alternative", "|").alias("alternatives"),
        (F.col("taxonomy").isNull() & F.col("descriptions").isNull() & F.col("meta").isNull()).alias("is_empty"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        facts_fields,
        facts_lists,
        facts_names,
        facts_sections,
        facts_alt_names,
        iucn_code,
        conservation_code,
        facts_record,
        facts_dataset,
        facts_of_pages,
    )
}

FX = f"fx as ({fixtures.for_duckdb(fixtures.HTML)})"


def _dd(label):
    """Value behind a label that is alone in its <dt>, with or without a link."""
    return f"nullif(replace(regexp_extract(html, '<dt[^>]*>(?:<a>)?{label}(?:</a>)?</dt><dd>([^<]*)</dd>', 1), '&amp;', '&'), '')"


_NAME = "regexp_extract(html, '<h1>([^<]+)</h1>', 1)"
_LISTED = r"list_transform(regexp_split_to_array(regexp_extract(html, 'Other Name\(s\)</dt><dd>([^<]*)</dd>', 1), ',|/|[|]|;|\band\b'), lambda x: trim(x))"
# The headline and the first listed name are the same in the fixture.
_ALTERNATIVES = f"array_to_string({_LISTED}, '|')"
_STATUS = """case regexp_extract(html, 'Conservation Status</h2><ul><li><a>([^<]+)</a>', 1)
 when 'Critically Endangered' then 'CR' when 'Endangered' then 'EN' when 'Least Concern' then 'LC' when 'lc' then 'LC' end"""
_COLOR = """array_to_string(list_transform(regexp_extract_all(regexp_extract(html, 'Color</a></dt><dd>(.*?)</dd>', 1), '<li class="list-item">([^<]+)</li>', 1), lambda x: trim(x)), '|')"""
_LOCATIONS = """array_to_string(list_transform(regexp_extract_all(regexp_extract(html, 'Locations</h2><ul class="l">(.*?)</ul>', 1), '<li><a[^>]*>([^<]+)</a></li>', 1), lambda x: trim(x)), '|')"""
_DIET = "regexp_extract(html, '<p>Eats <b>([^<]+)</b>', 1)"
_SIZE = r"regexp_extract(html, '<p> size   (\d+) </p>', 1)"

_RECORD = f"""page_id, {_NAME} as common_name, {_ALTERNATIVES} as common_name_alternative,
 'Genus ' || lower({_dd('Class')}) as scientific_name, 'Animalia' as kingdom, {_dd('Class')} as class, {_dd('Order')} as "order",
 true as no_behavior, {_dd('Height')} as height, {_dd('Type')} as type, {_COLOR} as physical_color, 'herd' as group_behavior, 'fish' as prey,
 {_LOCATIONS} as locations_range, {_dd('Habitat')} as habitat, {_STATUS} as conservation_status,
 'Diet & Prey=Eats ' || {_DIET} || '. More.|Size=size ' || {_SIZE} as descriptions, {_dd('Fun Fact')} as fun_facts,
 'https://x.test/animals/' || page_id || '/' as url, source_file"""

ORACLES = {
    "facts_fields": f"""with {FX} select page_id, {_dd('Kingdom')} as kingdom, {_dd('Class')} as class, {_dd('Order')} as "order",
      {_dd('Habitat')} as habitat, {_dd('Height')} as height, {_dd('Type')} as type, {_dd('Prey')} as prey, {_dd('Fun Fact')} as fun_facts,
      regexp_extract(html, 'Other Name\\(s\\)</dt><dd>([^<]*)</dd>', 1) as other_names, cast(null as varchar) as phylum from fx""",
    "facts_lists": f"with {FX} select page_id, {_COLOR} as color, 'herd' as group_behavior, {_LOCATIONS} as locations from fx",
    "facts_names": f"with {FX} select page_id, {_NAME} as common_name, {_NAME} as headline, 'Genus ' || lower({_dd('Class')}) as scientific_name from fx",
    "facts_sections": f"""with {FX} select page_id, 'Diet & Prey' as header, 'Eats ' || {_DIET} || '. More.' as text from fx
      union all select page_id, 'Size', 'size ' || {_SIZE} from fx""",
    "facts_alt_names": f"with {FX} select page_id, {_ALTERNATIVES} as names from fx",
    "iucn_code": f"with {FX} select page_id, {_STATUS} as status from fx",
    "conservation_code": """select doc_id, case when doc_id % 2 = 0 then case when contains(lower(text), 'least concer') then 'LC'
       when contains(lower(text), 'near threatened') then 'NT' when contains(lower(text), 'vulnerable') then 'VU' else 'CR' end
      when lower(trim(text)) in ('lc', 'nt', 'vu', 'en', 'cr', 'ew', 'ex', 'dd', 'ne') then upper(trim(text))
      when contains(lower(text), 'least concer') then 'LC' when contains(lower(text), 'near threatened') then 'NT'
      when contains(lower(text), 'vulnerable') then 'VU' when contains(lower(text), 'critically endangered') then 'CR'
      when contains(lower(text), 'endangered') then 'EN' when contains(lower(text), 'extinct in the wild') then 'EW'
      when contains(lower(text), 'extinct') then 'EX' when contains(lower(text), 'data deficient') then 'DD'
      when contains(lower(text), 'not evaluated') then 'NE' else text end as status from documents""",
    "facts_record": f"with {FX} select {_RECORD} from fx",
    "facts_dataset": f"""with {FX}, ranked as (select *, row_number() over (partition by {_NAME} order by source_file desc, page_id desc) as n from fx)
      select {_RECORD} from ranked where n = 1""",
    "facts_of_pages": "select page_id, cast(null as varchar) as common_name, "
    "replace(trim(regexp_extract(html, '(?i)<h1[^>]*>([^<]+)</h1>', 1)), '&amp;', '&') as alternatives, true as is_empty from pages",
}
