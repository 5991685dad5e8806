"""Inputs that no given table holds, derived from whole tables by the same SQL in both engines.

``ARR`` makes a list, ``EACH`` makes one row per element.
"""

from pyspark.sql import DataFrame, SparkSession

from sparkloom.operators.scale import dealt
from sparkloom.sources.readers import read_table

LEFT = """
select cast(c_custkey as varchar(20)) as key, c_name as common_name, ARR(concat('Alias ', c_custkey)) as common_name_alternative,
 concat('Genus', c_custkey, ' species', c_nationkey) as scientific_name from customer
"""

RIGHT = """
select concat('w', c_custkey, '-', d) as wiki_key, c_custkey * 10 + d as wiki_id, r,
 case r when 1 then c_name when 3 then concat(c_name, ' (x)') when 4 then concat('Alias ', c_custkey)
  when 6 then concat('Alias ', c_custkey, ' (x)') when 10 then concat('Genus', c_custkey, ' species', c_nationkey)
  when 11 then concat('Genus', c_custkey, ' species', c_nationkey, ' (x)') else concat('none ', c_custkey) end as animal_name,
 case r when 2 then ARR(upper(c_name)) when 5 then ARR(concat('alias  ', c_custkey)) end as animal_name_alternative,
 case r when 7 then ARR(concat('Genus', c_custkey, ' species', c_nationkey)) end as scientific_names,
 case r when 8 then concat('Genus', c_custkey, ' species', c_nationkey) end as taxon,
 case r when 9 then concat('Genus', c_custkey) end as genus, case r when 9 then concat('species', c_nationkey) end as species,
 concat('About ''''', c_name, ''''' &amp; more&nbsp;', r) as abstract, ARR('Range', 'Diet') as text_sections
from (select *, c_custkey % 12 as r, EACH(ARR(0, 1)) as d from customer) c
"""

HTML = """
select p_partkey as page_id, concat(replace(p_name, ' ', '_'), '_', p_partkey, '.html') as source_file,
 concat('<html><head><link rel="canonical" href="https://x.test/animals/', p_partkey, '/" /><meta name="robots" content="index"></head>',
 '<body><div id="title-header"><h1>', p_name, '</h1><p class="text-white">Genus ', lower(p_type), '</p></div>',
 '<dl><dt class="k"><a>Kingdom</a></dt><dd>Animalia</dd><dt><a>Class</a></dt><dd>', p_type, '</dd>',
 '<dt>Broken<dt>Order</dt><dd>', p_brand, ' &amp; co</dd><dt><a>Habitat</a></dt><dd>size ', p_size, '</dd>',
 '<dt><a>Color</a></dt><dd><ul><li class="list-item">red</li><li class="list-item">', p_brand, '</li></ul></dd>',
 '<dt><a>Group Behavior</a></dt><dd>herd</dd><dt>Height</dt><dd>', p_size, ' cm</dd><dt><a>Type</a></dt><dd>', p_type, '</dd>',
 '<dt>Main Prey</dt><dd><b>x</b></dd><dt>Prey</dt><dd>fish</dd><dt><a>Fun Fact</a></dt><dd>costs ', p_size, '</dd>',
 '<dt>Other Name(s)</dt><dd>', p_name, ', big ', p_name, ' and small one</dd></dl>',
 '<h2>Locations</h2><ul class="l"><li><a href="/x">Asia</a></li><li><a href="/y"> ', p_brand, '</a></li></ul>',
 '<h2>Conservation Status</h2><ul><li><a>', case p_partkey % 4 when 0 then 'Critically Endangered' when 1 then 'Endangered'
  when 2 then 'Least Concern' else 'lc' end, '</a></li></ul>',
 '<div id="single-animal-text"><h2>Diet &amp; Prey</h2><p>Eats <b>', p_type, '</b>.</p><p>More.</p><h2>FAQs</h2><p>no</p>',
 '<h2>Empty</h2><h2>Size</h2><p>old</p><h2>Size</h2><p> size   ', p_size, ' </p></div><div id="single-animal-sidebar"></div></body></html>') as html
from part
"""

WIKI = """
select doc_id as wiki_id, concat('Animal ', doc_id, ' (', lang, ')') as title, concat('chunk_', doc_id % 12, '.xml') as chunk,
 concat('{{Redirect|Old ', doc_id, '|other uses|Z (disambiguation)|[[Page|Label ', lang, ']]|OLD ', doc_id, '}}', chr(10),
 case doc_id % 3 when 0 then '{{Speciesbox' when 1 then '{{ speciesbox' else '{{Infobox' end, chr(10),
 '| status = LC <!-- c -->', chr(10), '| genus = ''''Genus''''', chr(10), '| species = ', lang, chr(10), '| taxon =', chr(10),
 '| status_ref = {{cite|title=''''Panthera leo'''' and Felis catus}}', chr(10), '| synonyms_ref = {{cite|title=Canis lupus ', lang, '}}', chr(10),
 '| title = [[', case doc_id % 4 when 0 then 'Subspecies' when 1 then 'Synonyms of ' else 'Synonymy' end, ']]', chr(10), '|{{Species list', chr(10), '|''''Vulpes ', lower(translate(cast(doc_id % 1000 as varchar(10)), '0123456789', 'abcdefghij')), 'us'''' L.', chr(10), '| range = wide', chr(10), '|''''Ursus arctos''''', chr(10), '}}', chr(10), '}}', chr(10), '}}', chr(10),
 'Intro [[A|', source, ']] [[B]] {{a|{{b}}}}<ref name="q"/><ref>x</ref> [[File:a.jpg|thumb]] ', text, chr(10), chr(10), chr(10), chr(10),
 '== Range ==', chr(10), 'x', chr(10), '=== Sub ===', chr(10), '== range ==', chr(10), '==Diet', source, '==', chr(10), '== References ==', chr(10),
 '[[Category:', lang, ' animals|k]] [[category:All]]') as text from documents
"""

# Pages that differ in kind by their number: closed, unclosed and three-deep boxes, no text, no title, headings that repeat.
WIKI_KINDS = """
select doc_id as wiki_id, doc_id % 7 as kind, case when doc_id % 7 <> 4 then concat('Page ', doc_id) end as title, concat('chunk_', doc_id % 5, '.xml') as chunk,
 case doc_id % 7
  when 0 then concat('{{Speciesbox', chr(10), '| genus = G', doc_id, chr(10), '}} Body ', lang, '.')
  when 1 then concat('{{Speciesbox', chr(10), '| genus = Open', chr(10), '| ref = {{cite|x}} Body ', lang, '.')
  when 2 then concat('{{speciesbox', chr(10), '| genus = ', lang, chr(10), '| status_ref = {{a|{{b|{{c}}}}}}', chr(10), '}}After {{x|{{y|{{z}}}}}}', lang, '.')
  when 3 then cast(null as varchar(10))
  when 4 then concat('{{Speciesbox', chr(10), '| genus = Untitled', chr(10), '}}')
  when 5 then concat('No box ', lang, chr(10), '== One ==', chr(10), 'x', chr(10), '==one==', chr(10), '== Two ==', chr(10), '== ONE ==', chr(10), '== References ==')
  else concat('Early {{Speciesbox', chr(10), '| genus =', chr(10), '| species = s', chr(10), '}} late', chr(10), '== ', source, ' ==') end as text
from documents
"""


def for_duckdb(sql: str) -> str:
    return sql.replace("ARR(", "list_value(").replace("EACH(", "unnest(")


def spark_fixture(spark: SparkSession, sf_dir: str, sql: str, table: str, short: bool = False) -> DataFrame:
    """The fixture's rows. Those of a ``short`` table are dealt to tasks first, as the steps after make much of each."""
    text = sql.replace("{", "{{").replace("}", "}}").replace("ARR(", "array(").replace("EACH(", "explode(")
    text = text.replace(f"from {table}", f"from {{{table}}}")
    rows = read_table(spark, f"{sf_dir}/{table}.parquet")
    return spark.sql(text, **{table: dealt(rows) if short else rows})


def left(spark, sf_dir):
    return spark_fixture(spark, sf_dir, LEFT, "customer")


def right(spark, sf_dir):
    return spark_fixture(spark, sf_dir, RIGHT, "customer")


def html(spark, sf_dir):
    return spark_fixture(spark, sf_dir, HTML, "part", short=True)


def wiki(spark, sf_dir):
    return spark_fixture(spark, sf_dir, WIKI, "documents")


def wiki_kinds(spark, sf_dir):
    return spark_fixture(spark, sf_dir, WIKI_KINDS, "documents")
