"""Merge matched records, add the unmatched right ones, and sum up the result."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkloom.fixed_values import MATCH_RULE_LABELS
from sparkloom.functions.columns import bind, blank_to_null, empty_array, empty_to_null, strip
from sparkloom.functions.text import unescape_html
from sparkloom.operators.scale import lookup_join

REDUNDANT = ("animal_name", "status", "taxon", "matched_name", "genus")


def _as_text(col: Column, kind: T.DataType) -> Column:
    return F.to_json(col) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else col.cast("string")


def _merged_column(name: str, left: T.DataType | None, right: T.DataType | None) -> Column:
    """Value of one column of both sides, by type.

    One side only: that side. Lists: ordered union, of texts where their items differ in kind. Differing
    scalars: a list of both, so scalar columns of both sides become lists. Other
    pairs: the left value, or the right one where the left is NULL; when their kinds differ the column
    has a common kind: a list of texts if one side is a list, else text, nested values as JSON.
    """
    a, b = F.col(f"l_{name}"), F.col(f"r_{name}")
    if right is None:
        return a.alias(name)
    if left is None:
        return b.alias(name)
    nested = (T.ArrayType, T.MapType, T.StructType)
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        if left.elementType != right.elementType:
            a, b = (F.transform(c, lambda x, k=k.elementType: _as_text(x, k)) for c, k in ((a, left), (b, right)))
        union = F.when(a == b, b).otherwise(F.array_distinct(F.concat(a, b)))
        return F.coalesce(union, a, b).alias(name)
    if not isinstance(left, nested) and not isinstance(right, nested):
        kind = left if left == right else T.StringType()
        both = F.array(a.cast(kind), b.cast(kind))
        return empty_to_null(F.array_distinct(F.filter(both, lambda x: x.isNotNull()))).alias(name)
    if left != right:
        as_list = isinstance(left, T.ArrayType) or isinstance(right, T.ArrayType)
        a, b = (_common(c, k, as_list) for c, k in ((a, left), (b, right)))
    return F.coalesce(a, b).alias(name)


def _common(col: Column, kind: T.DataType, as_list: bool) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _as_text(x, kind.elementType))
    text = _as_text(col, kind)
    return F.when(text.isNotNull(), F.array(text)) if as_list else text


def merge_records(left: DataFrame, right: DataFrame, matches: DataFrame) -> DataFrame:
    """Left record of every key joined with its matched right record, column by column.

    ``left`` is unique in ``key``, ``right`` in ``wiki_key``. The narrow matches fetch
    their right records first, as one right record may match very many keys and most keys
    may match none; the wide left records then join one to one.
    """
    lt = {f.name: f.dataType for f in left.schema.fields}
    rt = {f.name: f.dataType for f in right.schema.fields}
    prefixed = lambda df, key, prefix: df.select(key, *[F.col(c).alias(prefix + c) for c in df.columns if c != key])
    narrow = matches.select("key", "wiki_key", "matched_name", "match_type", F.col("wiki_id").alias("matched_id"))
    found = lookup_join(narrow, prefixed(right, "wiki_key", "r_"), ["wiki_key"], ["key"], "left")
    joined = prefixed(left, "key", "l_").join(found, "key", "left")
    names = [c for c in lt if c != "key"] + [c for c in rt if c not in lt and c not in ("wiki_key", "wiki_id")]
    return joined.select(
        "key",
        "wiki_key",
        *[_merged_column(c, lt.get(c), rt.get(c)) for c in names],
        "matched_name",
        "match_type",
        F.col("matched_id").alias("wiki_id"),
    )


def union_of_names(*lists: Column) -> Column:
    """Trimmed, non-blank, unique names of several lists, in order."""
    known = [F.coalesce(x, empty_array()) for x in lists]
    names = F.transform(F.concat(*known), strip)
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (n != "")))


def with_scientific_name(names: Column, *more: Column) -> Column:
    """Scientific names with further ones appended where missing; NULL when there are none."""
    extra = F.filter(F.array(*more), lambda n: n.isNotNull() & (n != ""))
    return empty_to_null(F.array_distinct(F.concat(F.coalesce(names, empty_array()), extra)))


def full_abstract(abstract: Column, headings: Column) -> Column:
    """Abstract without entities and quote marks, followed by the headings."""
    plain = F.regexp_replace(unescape_html(abstract), "''+", "")
    plain = strip(F.regexp_replace(plain, r"(?U)\s+", " "))
    titles = F.filter(F.transform(headings, strip), lambda t: t != "")
    return bind(
        F.struct(plain.alias("plain"), blank_to_null(F.array_join(titles, " ")).alias("titles")),
        lambda b: F.when(
            b["titles"].isNotNull(), strip(F.concat_ws(" ", blank_to_null(b["plain"]), b["titles"]))
        ).otherwise(b["plain"]),
    )


def _meta(df: DataFrame) -> Column:
    """``meta`` with the wiki id; a value that is no struct is kept as ``original_meta``."""
    wiki_id = F.col("wiki_id").alias("wiki_id")
    if "meta" not in df.columns:
        return F.struct(wiki_id)
    kind = df.schema["meta"].dataType
    if isinstance(kind, T.StructType):
        kept = [F.col("meta")[n].alias(n) for n in kind.names if n != "wiki_id"]
        return F.struct(*kept, wiki_id)
    return F.struct(F.col("meta").alias("original_meta"), wiki_id)


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _finished(df: DataFrame, changes: dict[str, Column], dropped: tuple[str, ...]) -> DataFrame:
    changes = {
        **changes,
        "meta": _meta(df),
        "abstract": full_abstract(_column(df, "abstract", "string"), _column(df, "text_sections", "array<string>")),
    }
    return df.withColumns(changes).drop("text_sections", "wiki_id", *REDUNDANT, *dropped)


def finish_merged(merged: DataFrame) -> DataFrame:
    """Merged records in output form: names united, id in ``meta``, abstract with headings."""
    changes = {
        "scientific_names": with_scientific_name(
            _column(merged, "scientific_names", "array<string>"), _column(merged, "scientific_name", "string")
        ),
        "common_name_alternative": union_of_names(
            _column(merged, "common_name_alternative", "array<string>"),
            _column(merged, "animal_name_alternative", "array<string>"),
        ),
    }
    return _finished(merged, changes, ("scientific_name", "animal_name_alternative"))


def right_only(right: DataFrame, matches: DataFrame) -> DataFrame:
    """Right records that no left record chose, mapped onto the left columns."""
    chosen = matches.filter(F.col("wiki_key").isNotNull()).select("wiki_key").distinct()
    rest = right.join(chosen, "wiki_key", "left_anti")
    pair = F.when(
        (_column(right, "genus", "string") != "") & (_column(right, "species", "string") != ""),
        strip(F.concat_ws(" ", _column(right, "genus", "string"), _column(right, "species", "string"))),
    )
    name = blank_to_null(_column(right, "common_name", "string"))
    alternatives = empty_to_null(_column(right, "common_name_alternative", "array<string>"))
    changes = {
        "common_name": F.coalesce(name, blank_to_null(_column(right, "animal_name", "string"))),
        "common_name_alternative": F.coalesce(alternatives, _column(right, "animal_name_alternative", "array<string>")),
        "scientific_names": with_scientific_name(
            _column(right, "scientific_names", "array<string>"), _column(right, "taxon", "string"), pair
        ),
    }
    return _finished(rest, changes, ())


def merged_union(merged: DataFrame, rest: DataFrame) -> DataFrame:
    """Merged and right-only records in one table; equal names stay apart by ``origin``."""
    both = merged.withColumn("origin", F.lit("merged"))
    right = rest.withColumn("key", F.col("wiki_key")).withColumn("origin", F.lit("right_only"))
    return both.unionByName(right, allowMissingColumns=True)


def match_type_counts(matches: DataFrame) -> DataFrame:
    """Rows ``(match_type, label, n_keys)``; unmatched keys have neither type nor label."""
    labels = F.create_map(*[F.lit(x) for pair in MATCH_RULE_LABELS.items() for x in pair])
    counts = matches.groupBy("match_type").agg(F.count("*").alias("n_keys"))
    return counts.select("match_type", F.try_element_at(labels, F.col("match_type")).alias("label"), "n_keys")


def counted_flags(merged: DataFrame) -> DataFrame:
    """Merged records (before ``finish_merged``) with what ``match_stats`` counts: ``n_appended``, ``n_alternatives``."""
    names = F.coalesce(_column(merged, "scientific_names", "array<string>"), empty_array())
    name = _column(merged, "scientific_name", "string")
    left_alt = union_of_names(_column(merged, "common_name_alternative", "array<string>"))
    right_alt = union_of_names(_column(merged, "animal_name_alternative", "array<string>"))
    appended = F.coalesce((name != "") & ~F.array_contains(names, name), F.lit(False)).cast("int")
    return merged.withColumns({"n_appended": appended, "n_alternatives": F.size(F.array_except(right_alt, left_alt))})


def match_stats(records: DataFrame) -> DataFrame:
    """One row of totals over the union of merged and right-only records; one aggregate, no join.

    ``records`` is ``merged_union(finish_merged(counted_flags(merged)), rest)``.
    """
    merged = F.col("origin") == "merged"
    per_type = [F.count_if(merged & (F.col("match_type") == code)).alias(f"match_type_{code}") for code in MATCH_RULE_LABELS]

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(merged, F.col(name))), F.lit(0)).cast("bigint")

    sums = records.agg(
        F.count_if(merged).alias("total_records"),
        F.count_if(merged & F.col("match_type").isNotNull()).alias("matched_records"),
        F.count_if(merged & F.col("match_type").isNull()).alias("unmatched_records"),
        *per_type,
        total("n_appended").alias("appended_scientific"),
        total("n_alternatives").alias("alt_names_merged"),
        F.count("meta.wiki_id").alias("with_meta_wiki_id"),
        F.count_if(F.col("origin") == "right_only").alias("right_only_records"),
    )
    return sums.withColumn("match_rate", F.coalesce(F.try_divide("matched_records", "total_records"), F.lit(0.0)))
