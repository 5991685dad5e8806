"""Structured records from wiki dump pages ``(wiki_id, title, text)``."""

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions import wikitext as W
from sparkloom.functions.columns import blank_to_null, empty_array, empty_to_null, strip
from sparkloom.operators.scale import keep_first


def pages_with_template(pages: DataFrame, name: str = "speciesbox") -> DataFrame:
    return pages.filter(W.has_template(F.col("text"), name))


def _matches(name: str) -> Column:
    return F.coalesce(W.has_template(F.col("text"), name), F.lit(False))


def marked_pages(pages: DataFrame, name: str = "speciesbox") -> DataFrame:
    """Pages with ``matches``; those that do not match keep nothing but their chunk."""
    matches = _matches(name)
    kept = [F.when(matches, F.col(c)).alias(c) for c in pages.columns if c != "chunk"]
    return pages.select("chunk", *kept, matches.alias("matches"))


def marks_report(marked: DataFrame) -> DataFrame:
    """Rows ``(chunk, total_pages, matched_pages, has_output)`` per file, and a total row with chunk NULL."""
    counts = marked.rollup("chunk").agg(F.count("*").alias("total_pages"), F.count_if("matches").alias("matched_pages"))
    return counts.withColumn("has_output", F.col("matched_pages") > 0)


def filter_report(pages: DataFrame, name: str = "speciesbox") -> DataFrame:
    """``marks_report`` of pages, those without title included."""
    return marks_report(pages.select("chunk", _matches(name).alias("matches")))


def record_names(block: Column) -> Column:
    """Scientific names of a box: synonyms, then names in ``status_ref``, then genus with species."""
    genus, species = W.template_field(block, "genus"), W.template_field(block, "species")
    pair = F.when(genus.isNotNull() & species.isNotNull(), F.array(F.concat_ws(" ", genus, species)))
    return F.array_distinct(
        F.concat(
            W.synonyms(block),
            W.scientific_names(W.template_field(block, "status_ref")),
            F.coalesce(pair, empty_array()),
        )
    )


def extract_wiki_records(pages: DataFrame, name: str = "speciesbox") -> DataFrame:
    """Wiki record of every page with a title.

    The box is cut out of the text once; its fields are then read from the box alone. A
    page without box is read from its start, a page without text keeps id and title.
    """
    order = [c for c in pages.columns if c not in ("wiki_id", "title", "text", "page")]
    titled = pages.filter(F.col("title").isNotNull()).select("wiki_id", strip(F.col("title")).alias("title"), "text", *order)
    boxed = titled.withColumn("box", W.template_block(F.col("text"), name))
    split = boxed.withColumns({"block": F.col("box.block"), "body": F.coalesce(F.col("box.after"), F.col("text"))})
    block, text, body = F.col("block"), F.col("text"), F.col("body")
    return split.select(
        "wiki_id",
        F.col("title").alias("animal_name"),
        *[W.template_field(block, f).alias(f) for f in ("status", "genus", "species", "taxon")],
        F.when(text.isNotNull(), F.when(block.isNotNull(), record_names(block)).otherwise(empty_array())).alias(
            "scientific_names"
        ),
        W.redirect_titles(text).alias("animal_name_alternative"),
        W.abstract(body).alias("abstract"),
        W.headings(body).alias("text_sections"),
        W.categories(text).alias("categories"),
        *order,
    )


def dedupe_pages(pages: DataFrame, order: list[Column] | None = None, title: str = "title") -> DataFrame:
    """One page per id, or per title where the id is missing; the first in ``order`` stays.

    Dump rows have no position, so the default order is file, title, text. Extracted
    records may be deduplicated instead (``title="animal_name"``): they are much smaller
    than their pages, so less is shuffled.
    """
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in ("chunk", title, "text", "abstract") if c in pages.columns]
    keyed = pages.withColumn("_title", F.when(F.col("wiki_id").isNull(), F.col(title)))
    return keep_first(keyed, ["wiki_id", "_title"], order).drop("_title")


def prune_nulls(records: DataFrame) -> DataFrame:
    """Empty lists become NULL, so the JSON writer leaves them out."""
    arrays = {f.name for f in records.schema.fields if f.dataType.typeName() == "array"}
    return records.select(*[empty_to_null(F.col(c)).alias(c) if c in arrays else F.col(c) for c in records.columns])


def records_by_name(records: DataFrame) -> DataFrame:
    """One record per name, empty parts NULL; of several the one with the highest id stays."""
    named = records.filter(F.col("animal_name").isNotNull() & (F.col("animal_name") != ""))
    return prune_nulls(keep_first(named, ["animal_name"], [F.desc_nulls_last("wiki_id")]))


def key_records(records: DataFrame, ordinal: str, *candidates: Column) -> DataFrame:
    """Give each record a ``key``: the first non-empty candidate, else ``row_<ordinal>``.

    Of records with the same key the last one stays.
    """
    names = [blank_to_null(c.cast("string")) for c in candidates]
    key = F.coalesce(*names, F.concat(F.lit("row_"), F.col(ordinal).cast("string")))
    return keep_first(records.withColumn("key", key), ["key"], [F.desc(ordinal)])


def _present(records: DataFrame, name: str) -> Column:
    return F.col(name) if name in records.columns else F.lit(None)


def left_key_candidates(records: DataFrame) -> tuple[Column, ...]:
    """Common name, name, key; columns that ``records`` lacks count as NULL."""
    return tuple(_present(records, c) for c in ("common_name", "name", "key"))


def right_key_candidates(records: DataFrame) -> tuple[Column, ...]:
    """Title, taxon, genus with species, id; columns that ``records`` lacks count as NULL."""
    genus, species = _present(records, "genus"), _present(records, "species")
    pair = F.when((genus != "") & (species != ""), F.concat_ws(" ", genus, species))
    return (_present(records, "animal_name"), _present(records, "taxon"), pair, _present(records, "wiki_id"))
