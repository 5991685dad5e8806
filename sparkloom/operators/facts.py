"""Structured facts from HTML pages: one record per page, built from column expressions only."""

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.fixed_values import CONSERVATION_PATTERN, FACTS_URL_PATTERN, LOCATIONS_PATTERN, NAME_BREAKS_PATTERN
from sparkloom.functions import html as H
from sparkloom.functions.columns import bind, blank_to_null, empty_array, first_of, strip, unique_by
from sparkloom.functions.text import conservation_code, decode_entities
from sparkloom.operators.scale import keep_first

# Record field -> (label, how the label is found). "within": anywhere in the
# <dt>, value without tags. "link": the <dt> is just a link with this text, value without
# tags. "has_link": the <dt> holds such a link. "+": the value may hold tags.
FACT_LABELS = {
    "kingdom": ("Kingdom", "within"),
    "phylum": ("Phylum", "within"),
    "class": ("Class", "within"),
    "order": ("Order", "within"),
    "family": ("Family", "within"),
    "genus": ("Genus", "within"),
    "habitat": ("Habitat", "link"),
    "location": ("Location", "link"),
    "color": ("Color", "link+"),
    "skin_type": ("Skin Type", "within"),
    "type": ("Type", "has_link"),
    "top_speed": ("Top Speed", "within"),
    "lifespan": ("Lifespan", "within"),
    "weight": ("Weight", "within"),
    "length": ("Length", "within"),
    "height": ("Height", "within+"),
    "wingspan": ("Wingspan", "within"),
    "distinctive_features": ("Most Distinctive Feature", "within"),
    "venomous": ("Venomous", "within"),
    "aggression": ("Aggression", "within"),
    "life_style": ("Life Style", "within"),
    "group_behavior": ("Group Behavior", "link+"),
    "diet": ("Diet", "within"),
    "prey": ("Prey", "within"),
    "predators": ("Predators", "within"),
    "gestation_period": ("Gestation Period", "within"),
    "incubation_period": ("Incubation Period", "within"),
    "average_litter_size": ("Average Litter Size", "within"),
    "average_clutch_size": ("Average Clutch Size", "within"),
    "name_of_young": ("Name of Young", "within"),
    "age_of_sexual_maturity": ("Age of Sexual Maturity", "within"),
    "age_of_weaning": ("Age of Weaning", "within"),
    "age_of_fledging": ("Age of Fledging", "within"),
    "biggest_threat": ("Biggest Threat", "within"),
    "estimated_population": ("Estimated Population Size", "within"),
    "fun_facts": ("Fun Fact", "link"),
    "number_of_species": ("Number of Species", "link"),
    "other_names": ("Other Name(s)", "within"),
    "group_name": ("Group", "link"),
}

# Record groups in output order.
FACT_GROUPS = {
    "taxonomy": ("kingdom", "phylum", "class", "order", "family", "genus"),
    "behavior": ("venomous", "aggression", "life_style"),
    "physical_characteristics": (
        "skin_type",
        "type",
        "top_speed",
        "lifespan",
        "weight",
        "length",
        "height",
        "wingspan",
        "distinctive_features",
    ),
    "biological_facts": (
        "diet",
        "prey",
        "predators",
        "gestation_period",
        "incubation_period",
        "average_litter_size",
        "average_clutch_size",
        "name_of_young",
        "age_of_sexual_maturity",
        "age_of_weaning",
        "age_of_fledging",
    ),
    "habitat_distribution": ("habitat", "location"),
    "conservation": ("conservation_status", "biggest_threat", "estimated_population"),
}


def pair_value(pairs: Column, label: str, how: str) -> Column:
    """Value of the first ``<dt>/<dd>`` pair with this label."""
    link = rf"(?i)<a[^>]*>\Q{label}\E</a>"
    tests = {
        "within": lambda p: p["label"].contains(label.lower()),
        "link": lambda p: p["label_html"].rlike(link.replace("(?i)", r"(?i)^\s*") + r"\s*$"),
        "has_link": lambda p: p["label_html"].rlike(link),
    }
    found = tests[how.rstrip("+")]
    if not how.endswith("+"):
        return first_of(F.filter(pairs, lambda p: p["plain"] & found(p)))["value"]
    return first_of(F.filter(pairs, found))["value"]


def fact_fields(pages: DataFrame, fields: dict[str, tuple[str, str]] = FACT_LABELS) -> DataFrame:
    """One column per labelled field, next to all columns of ``pages``.

    The page is scanned once for its pairs; the fields then look at the short pairs only.
    """
    paired = pages.withColumn("_pairs", H.definition_pairs(F.col("html")))
    return paired.select(
        *pages.columns, *[pair_value(F.col("_pairs"), label, how).alias(f) for f, (label, how) in fields.items()]
    )


def alternative_names(headline: Column, other_names: Column) -> Column:
    """Other names of a page: its headline, then the listed names; unique regardless of case."""
    listed = F.transform(F.split(other_names, NAME_BREAKS_PATTERN), strip)
    names = F.concat(F.when(headline.isNotNull(), F.array(headline)).otherwise(empty_array()), F.coalesce(listed, empty_array()))
    return unique_by(F.filter(names, lambda n: n != ""), F.lower)


def location_list(html: Column) -> Column:
    """Places of the locations list; NULL when the page has no such list."""
    return bind(
        F.regexp_extract(html, LOCATIONS_PATTERN, 0),
        lambda found: F.when(
            found != "", H.linked_items(decode_entities(strip(F.regexp_extract(found, LOCATIONS_PATTERN, 1))))
        ),
    )


def conservation_status(html: Column) -> Column:
    text = blank_to_null(decode_entities(strip(F.regexp_extract(html, CONSERVATION_PATTERN, 1))))
    return conservation_code(text)


def _group(*names: str) -> Column:
    """Struct of the named columns; NULL when all of them are."""
    return F.when(F.coalesce(*names).isNotNull(), F.struct(*names))


def extract_facts(pages: DataFrame) -> DataFrame:
    """Facts record of every page ``(page_id, html, source_file)``; empty parts are NULL."""
    html = F.col("html")
    source = F.col("source_file") if "source_file" in pages.columns else F.lit(None).cast("string")
    flat = fact_fields(pages.select("page_id", "html", source.alias("source_file")))
    flat = flat.withColumns(
        {
            "common_name": H.title_header(html),
            "headline": H.headline(html),
            "scientific_name": H.title_scientific_name(html),
            "locations_range": location_list(html),
            "conservation_status": conservation_status(html),
            "sections": H.text_sections(html),
            "url": blank_to_null(decode_entities(strip(F.regexp_extract(html, FACTS_URL_PATTERN, 1)))),
        }
    )
    groups = {name: _group(*fields) for name, fields in FACT_GROUPS.items()}
    return flat.select(
        "page_id",
        "common_name",
        alternative_names(F.col("headline"), F.col("other_names")).alias("common_name_alternative"),
        "scientific_name",
        groups["taxonomy"].alias("taxonomy"),
        "number_of_species",
        groups["behavior"].alias("behavior"),
        groups["physical_characteristics"].alias("physical_characteristics"),
        H.items_or_text(F.col("color")).alias("physical_color"),
        H.items_or_text(F.col("group_behavior")).alias("group_behavior"),
        groups["biological_facts"].alias("biological_facts"),
        "locations_range",
        groups["habitat_distribution"].alias("habitat_distribution"),
        groups["conservation"].alias("conservation"),
        bind(
            F.col("sections"),
            lambda s: F.when(
                F.size(s) > 0,
                F.map_from_arrays(F.transform(s, lambda x: x["header"]), F.transform(s, lambda x: x["text"])),
            ),
        ).alias("descriptions"),
        "fun_facts",
        "group_name",
        _group("url", "source_file").alias("meta"),
    )


def facts_dataset(facts: DataFrame) -> DataFrame:
    """One record per common name; of several pages the one with the last file name (then page) stays."""
    named = facts.filter(F.col("common_name").isNotNull() & (F.col("common_name") != ""))
    order = [F.desc_nulls_last(F.col("meta").getField("source_file")), F.desc("page_id")]
    return keep_first(named, ["common_name"], order)
