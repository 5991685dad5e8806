"""Entity matching by ranked name rules.

Left records ``(key, common_name, common_name_alternative, scientific_name)`` are matched
with right records ``(wiki_key, animal_name, animal_name_alternative, scientific_names,
wiki_id, taxon, genus, species)``. Eleven rules compare normal forms of their names; the
match with the lowest rule, then the lowest ``wiki_id``, wins.

Written as one join condition the rules are an OR without a common key, which Spark can
only run as a nested loop. Here every name becomes a row ``(kind, value)``, and equal
values meet in one equi-join. Only the first right record per value and kind can win, so
the right side is reduced to one row per value before the join: the join never multiplies
rows, however often a name occurs on either side.
"""

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions.columns import blank_to_null
from sparkloom.functions.text import base_name, norm_text
from sparkloom.operators.scale import lookup_join

# Rule code by left and right kind of name.
RULES = {
    ("common", "title"): 1,
    ("common", "alternative"): 2,
    ("common", "base"): 3,
    ("alternative", "title"): 4,
    ("alternative", "alternative"): 5,
    ("alternative", "base"): 6,
    ("scientific", "scientific"): 7,
    ("scientific", "taxon"): 8,
    ("scientific", "genus_species"): 9,
    ("scientific", "title"): 10,
    ("scientific", "base"): 11,
}
LEFT_KINDS = ("common", "alternative", "scientific")
RIGHT_KINDS = ("title", "alternative", "base", "scientific", "taxon", "genus_species")

LEFT_SCHEMA = "key string, common_name string, common_name_alternative array<string>, scientific_name string"
RIGHT_SCHEMA = (
    "wiki_key string, animal_name string, animal_name_alternative array<string>, "
    "scientific_names array<string>, wiki_id bigint, taxon string, genus string, species string"
)


def _typed(records: DataFrame, schema: str) -> DataFrame:
    columns = []
    for part in schema.split(", "):
        name, kind = part.split(" ", 1)
        col = F.col(name).cast(kind) if name in records.columns else F.lit(None).cast(kind)
        columns.append((F.coalesce(col, F.array().cast(kind)) if kind.startswith("array") else col).alias(name))
    return records.select(*columns)


def left_rows(records: DataFrame) -> DataFrame:
    """The typed columns that matching needs; missing lists are empty."""
    return _typed(records, LEFT_SCHEMA)


def right_rows(records: DataFrame) -> DataFrame:
    return _typed(records, RIGHT_SCHEMA)


def genus_species() -> Column:
    return F.concat_ws(" ", "genus", "species")


def _names(kind: str, raws: Column) -> Column:
    """Array of ``(kind, pos, raw)`` from an array of names."""
    return F.transform(
        raws, lambda raw, i: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("pos"), raw.alias("raw"))
    )


def left_names(left: DataFrame) -> DataFrame:
    """Rows ``(key, kind, value)``, at least one per record; without usable name the value is NULL."""
    names = F.concat(
        _names("common", F.array("common_name")),
        _names("alternative", F.coalesce("common_name_alternative", F.array().cast("array<string>"))),
        _names("scientific", F.array("scientific_name")),
    )
    rows = left.select("key", F.explode(names).alias("n"))
    return rows.select("key", "n.kind", blank_to_null(norm_text(F.col("n.raw"))).alias("value"))


def right_names(right: DataFrame) -> DataFrame:
    """Rows ``(wiki_key, wiki_id, kind, pos, raw, value)`` of all usable names."""
    none = F.array().cast("array<string>")
    title = F.col("animal_name")
    names = F.concat(
        _names("title", F.array(title)),
        _names("alternative", F.coalesce("animal_name_alternative", none)),
        _names("base", F.array(title)),
        _names("scientific", F.coalesce("scientific_names", none)),
        _names("taxon", F.array("taxon")),
        _names("genus_species", F.array(genus_species())),
    )
    rows = right.select("wiki_key", "wiki_id", F.explode(names).alias("n"))
    spelled = F.when(F.col("n.kind") == "base", base_name(F.col("n.raw"))).otherwise(F.col("n.raw"))
    rows = rows.select("wiki_key", "wiki_id", "n.kind", "n.pos", "n.raw", norm_text(spelled).alias("value"))
    return rows.filter(F.col("value") != "")


def best_by_value(right: DataFrame) -> DataFrame:
    """One row per value: for each kind the first right record that has it.

    A minimum per kind: tasks send one row per value, so a value that a third of all
    records share costs no more than any other.
    """
    first = F.struct("wiki_id", "wiki_key", "pos", "raw")
    best = [F.min(F.when(F.col("kind") == k, first)).alias(f"best_{k}") for k in RIGHT_KINDS]
    return right_names(right).groupBy("value").agg(*best)


def match_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows ``(key, best)``: best match per left name, NULL without one."""
    found = lookup_join(left_names(left), best_by_value(right), ["value"], ["key", "kind"], "left")

    def candidate(left_kind: str, right_kind: str, rule: int) -> Column:
        best = F.col(f"best_{right_kind}")
        ranked = F.struct(F.lit(rule).alias("rule"), *[best[c].alias(c) for c in ("wiki_id", "wiki_key", "pos", "raw")])
        return F.when((F.col("kind") == left_kind) & best.isNotNull(), ranked)

    return found.select("key", F.least(*[candidate(lk, rk, rule) for (lk, rk), rule in RULES.items()]).alias("best"))


def match_entities(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows ``(key, wiki_key, matched_name, match_type, wiki_id)``: one per left key.

    Keys without a match stay, with NULLs. Ties of rule and ``wiki_id`` go to the lower
    ``wiki_key``. NULL ids come first.
    """
    best = match_candidates(left, right).groupBy("key").agg(F.min("best").alias("best"))
    rule, raw = F.col("best.rule"), F.col("best.raw")
    return best.select(
        "key",
        F.col("best.wiki_key").alias("wiki_key"),
        F.when(rule.isin(6, 11), base_name(raw)).otherwise(raw).alias("matched_name"),
        rule.alias("match_type"),
        F.col("best.wiki_id").alias("wiki_id"),
    )
