"""Readers: wiki dumps, HTML folders, keyed JSON, URL lists."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkloom.functions.columns import strip

# Everything that a page of an export holds; attributes begin with "_".
_REVISION = (
    "struct<id:bigint, parentid:bigint, timestamp:string, contributor:struct<_deleted:string, username:string, id:bigint, ip:string>, minor:string, "
    "comment:struct<_VALUE:string, _deleted:string>, origin:bigint, model:string, format:string, "
    "text:struct<_VALUE:string, _bytes:bigint, _sha1:string, _deleted:string>, sha1:string>"
)
_PAGE_SCHEMA = f"title string, ns bigint, id bigint, redirect struct<_title:string, _VALUE:string>, restrictions string, revision array<{_REVISION}>"
_CHUNK_NUMBER = r"chunk_(\d+)_filtered\.xml"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; ``spark.sql.files.maxPartitionBytes`` says how finely files are split."""
    return spark.read.parquet(path)


def read_dump_pages(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(wiki_id, title, text, chunk, page)``, one per ``<page>``; the title may be missing.

    Large files are split at page borders. ``text`` is that of the first revision, ``page``
    the whole page with all revisions, so that it can be written again; nobody who leaves it out pays for it. ``chunk`` is
    the name of the file; where files lie in a ``chunk=`` folder, as ``write_filtered_pages`` makes them, that of the folder.
    The id is the first one in the page, so the one of its revision where it has none.
    """
    pages = spark.read.schema(_PAGE_SCHEMA).option("rowTag", "page").option("ignoreNamespace", True)
    pages = pages.option("recursiveFileLookup", True).xml(path)
    folder = F.url_decode(F.regexp_extract("_metadata.file_path", r"/chunk=([^/]+)/", 1))
    first = F.get("revision", F.lit(0))
    return pages.select(
        F.coalesce("id", first["id"]).alias("wiki_id"),
        "title",
        first["text"]["_VALUE"].alias("text"),
        F.when(folder != "", folder).otherwise(F.col("_metadata.file_name")).alias("chunk"),
        F.struct("title", "ns", "id", "redirect", "restrictions", "revision").alias("page"),
    )


def chunk_number(chunk: Column) -> Column:
    """Number of a filtered chunk, -1 for other names; chunks sort by it, not by name."""
    number = F.regexp_extract(chunk, _CHUNK_NUMBER + "$", 1)
    return F.coalesce(number.try_cast("bigint"), F.lit(-1).cast("bigint"))


def read_filtered_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Pages of all filtered chunks below ``path``, with their ``chunk_no``."""
    pages = read_dump_pages(spark, path).withColumn("chunk_no", chunk_number(F.col("chunk")))
    return pages.filter(F.col("chunk_no") >= 0)


def read_html_dir(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """Rows ``(source_file, html)`` of the files whose names fit ``pattern``."""
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("html"))


def read_keyed_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(name, record, source)`` of a JSON object, ``record`` being JSON text; comments are allowed.

    One object is one row to Spark and cannot be split: read it once and store the result.
    A file that holds no object raises an error.
    """
    files = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string,string>", {"allowComments": "true", "mode": "PERMISSIVE"})
    checked = F.coalesce(parsed, F.raise_error(F.lit("not a JSON object")).cast("map<string,string>"))
    rows = files.select(F.explode(checked).alias("name", "record"), F.col("_metadata.file_path").alias("source"))
    # A value that is no JSON by itself was a string and lost its quotes.
    quoted = F.regexp_replace(F.to_json(F.array("record")), r"^\[|\]$", "")
    return rows.withColumn("record", F.when(F.try_parse_json("record").isNull(), quoted).otherwise(F.col("record")))


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records stored by ``write_keyed_records``; the schema is given, so nothing is scanned to guess it."""
    return spark.read.schema(schema).json(path)


def read_url_set(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-blank lines as ``(url)``."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("url"))
    return lines.filter(F.col("url") != "").distinct()
