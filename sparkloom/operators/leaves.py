"""Leaves of nested records: one row per scalar, with its path and its nearest key.

Two ways in: typed columns, whose leaves follow from the schema, and VARIANT (any JSON),
which is opened level by level inside the row. Neither shuffles.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkloom.fixed_values import CONTENT_SKIPPED_KEYS
from sparkloom.functions.columns import bind, strip

LEAF = "array<struct<path:string,key:string,value:string,skip:boolean>>"


def _leaf(path: Column, key: Column, value: Column, skip: Column) -> Column:
    return F.struct(path.alias("path"), key.alias("key"), value.cast("string").alias("value"), skip.alias("skip"))


def _typed(col: Column, kind: T.DataType, path: Column, key: Column, skip: Column) -> Column:
    """Leaves of one typed column, in schema order."""
    if isinstance(kind, T.StructType):
        parts = [
            _typed(
                col.getField(f.name),
                f.dataType,
                F.when(path == "", F.lit(f.name)).otherwise(F.concat(path, F.lit("." + f.name))),
                F.lit(f.name),
                skip | F.lit(f.name.lower() in CONTENT_SKIPPED_KEYS),
            )
            for f in kind.fields
        ]
        return F.concat(*parts)
    if isinstance(kind, T.ArrayType):
        inner = F.transform(col, lambda x: _typed(x, kind.elementType, path, key, skip))
        return F.coalesce(F.flatten(inner), F.array().cast(LEAF))
    if isinstance(kind, T.MapType):
        inner = F.transform(
            F.map_entries(col),
            lambda e: _typed(
                e["value"],
                kind.valueType,
                F.when(path == "", e["key"]).otherwise(F.concat(path, F.lit("."), e["key"])),
                e["key"],
                skip | F.lower(e["key"]).isin(*CONTENT_SKIPPED_KEYS),
            ),
        )
        return F.coalesce(F.flatten(inner), F.array().cast(LEAF))
    if isinstance(kind, T.VariantType):
        return variant_leaves(col, path=path, key=key, skip=skip)
    present = F.array(_leaf(path, key, col, skip)).cast(LEAF)
    return F.when(col.isNotNull(), present).otherwise(F.array().cast(LEAF))


def typed_leaves(df: DataFrame, columns: list[str]) -> Column:
    """Array of the leaves of ``columns``; NULLs have none."""
    struct = T.StructType([df.schema[c] for c in columns])
    return _typed(F.struct(*columns), struct, F.lit(""), F.lit(""), F.lit(False))


_JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _levels(text: Column) -> Column:
    """Levels of a JSON text: the deepest place of its brackets outside of strings, in one pass."""
    runs = F.regexp_extract_all(F.regexp_replace(text, _JSON_STRING + r"|[^{}\[\]\"]++", ""), F.lit(r"([{\[]+|[}\]]+)"), F.lit(1))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(1).alias("deepest"))

    def step(acc: Column, run: Column) -> Column:
        depth = acc["depth"] + F.when(run.startswith("{") | run.startswith("["), F.length(run)).otherwise(-F.length(run))
        return F.struct(depth.alias("depth"), F.greatest(acc["deepest"], depth).alias("deepest"))

    return F.coalesce(F.aggregate(runs, zero, step)["deepest"], F.lit(1))


def variant_leaves(
    value: Column,
    path: Column | None = None,
    key: Column | None = None,
    skip: Column | None = None,
    text: Column | None = None,
) -> Column:
    """Array of the leaves of a VARIANT column; ``text`` is its JSON where at hand.

    A list passes its key down to its items. The record is opened level by level, as
    often as its brackets are deep.
    """
    entries = "map<string,variant>"
    node = F.struct(
        (F.lit("") if path is None else path).alias("path"),
        (F.lit("") if key is None else key).alias("key"),
        value.alias("value"),
        (F.lit(False) if skip is None else skip).alias("skip"),
    )

    def children(n: Column) -> Column:
        named = F.transform(
            F.map_entries(n["value"].try_cast(entries)),
            lambda e: F.struct(
                F.when(n["path"] == "", e["key"]).otherwise(F.concat(n["path"], F.lit("."), e["key"])).alias("path"),
                e["key"].alias("key"),
                e["value"].alias("value"),
                (n["skip"] | F.lower(e["key"]).isin(*CONTENT_SKIPPED_KEYS)).alias("skip"),
            ),
        )
        items = F.transform(
            n["value"].try_cast("array<variant>"),
            lambda v: F.struct(n["path"].alias("path"), n["key"].alias("key"), v.alias("value"), n["skip"].alias("skip")),
        )
        return F.coalesce(named, items, F.array(n))

    def nested(n: Column) -> Column:
        return n["value"].try_cast(entries).isNotNull() | n["value"].try_cast("array<variant>").isNotNull()

    def one_level(acc: Column, _: Column) -> Column:
        opened = bind(
            F.flatten(F.transform(acc["nodes"], children)),
            lambda nodes: F.struct(nodes.alias("nodes"), (~F.exists(nodes, nested)).alias("done")),
        )
        return F.when(acc["done"], acc).otherwise(opened)

    start = F.struct(F.array(node).alias("nodes"), F.lit(False).alias("done"))
    nodes = F.aggregate(F.sequence(F.lit(1), _levels(F.to_json(value) if text is None else text)), start, one_level)["nodes"]

    def scalar(n: Column) -> Column:
        return _leaf(n["path"], n["key"], F.when(~nested(n), n["value"].cast("string")), n["skip"])

    return F.filter(F.transform(nodes, scalar), lambda n: n["value"].isNotNull())


def json_leaves(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Rows ``(doc_id, pos, path, key, value)`` of the leaves of a JSON text column.

    Text that is no JSON has no leaves; ``malformed_json`` gives those rows out.
    """
    leaves = variant_leaves(F.try_parse_json(json_col), text=F.col(json_col))
    return _exploded(df, id_col, leaves)


def malformed_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Rows ``(doc_id, text)`` whose text is no JSON; NULL is not malformed."""
    bad = F.col(json_col).isNotNull() & F.try_parse_json(json_col).isNull()
    return df.filter(bad).select(F.col(id_col).alias("doc_id"), F.col(json_col).alias("text"))


def record_leaves(df: DataFrame, id_col: str, columns: list[str] | None = None) -> DataFrame:
    """Rows ``(doc_id, pos, path, key, value)`` of the leaves of typed columns."""
    columns = columns or [c for c in df.columns if c != id_col]
    return _exploded(df, id_col, typed_leaves(df, columns))


def _exploded(df: DataFrame, id_col: str, leaves: Column) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), F.posexplode(leaves).alias("pos", "leaf")).select(
        "doc_id", "pos", "leaf.path", "leaf.key", "leaf.value"
    )


def content(leaves: Column, name: Column) -> Column:
    """Full-text content of a record: its leaves line by line, its name when there are none."""
    kept = F.filter(leaves, lambda n: ~n["skip"] & (n["value"] != ""))
    text = strip(F.array_join(F.transform(kept, lambda n: n["value"]), "\n"))
    return bind(text, lambda t: F.when(t != "", t).otherwise(name))
