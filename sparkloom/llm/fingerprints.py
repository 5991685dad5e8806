"""Document fingerprints: the smallest hashes of a text's shingles, in built-in functions only."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.llm.common import let, split_words
from sparkloom.operators.scale import cut_lineage, top_k

SIZE = 128
WIDTH = 5

# Hex digits of a hash: 48 bits.
DIGITS = 12

# Rows of one partition have ids that agree above this many bits (``monotonically_increasing_id``).
_PART_BITS = 33


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hash of every run of ``width`` words, as hex digits; one of all words if there are fewer, none without words."""

    def hashed(words: Column) -> Column:
        starts = F.slice(words, 1, F.greatest(F.size(words) - (width - 1), F.lit(1)))
        return F.transform(starts, lambda _, i: F.left(F.md5(F.array_join(F.slice(words, i + 1, width), " ")), F.lit(DIGITS)))

    return let(split_words(text), hashed)


def bottom(hashes: Column, size: int = SIZE) -> Column:
    """The sketch of a set of hashes: its ``size`` smallest, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def sketch(text: Column, size: int = SIZE, width: int = WIDTH) -> Column:
    return bottom(shingle_hashes(text, width), size)


def merge(a: Column, b: Column, size: int = SIZE) -> Column:
    """Sketch of the union of two sets from their sketches."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of common shingles among all of both: of the union's smallest hashes, those that both sketches have.

    Exact while both sets fit into the sketch. Two empty sets are alike (1), an empty one and another are not (0).
    """
    both = let(merge(a, b, size), lambda m: F.size(F.array_intersect(m, F.array_intersect(a, b))) / F.size(m))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both)


def distinct_count(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles: exact below ``size``, else from how dense the smallest hashes lie."""
    share = F.conv(F.element_at(a, -1), 16, 10).cast("double") / float(1 << (4 * DIGITS))
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / share)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 where ``a`` has none."""
    common = resemblance(a, b, size) * distinct_count(merge(a, b, size), size)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_count(a, size)))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, width: int = WIDTH) -> DataFrame:
    """Rows ``(doc_id, n_chars, sketch)``, one per row of ``df``.

    ``sketch`` has the ``size`` smallest distinct hashes (hex, ascending) of the text's runs of ``width`` words
    ``[^\\x20\\x09-\\x0D]+``; a text with fewer words is one run. Equal texts have equal sketches.

    Null texts are empty; texts without words have an empty sketch. Repeated rows and null ids are rows of their own.
    Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    return docs.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), sketch(F.col("text"), size, width).alias("sketch"))


def merged(parts: DataFrame, keys: list[str], size: int = SIZE) -> DataFrame:
    """Rows ``(*keys, sketch)``: the sketch of the union of all ``sketch`` of a key.

    Hashes are made distinct and cut to the smallest of a key in every task before they are brought together, so a key
    with very many parts sends a sketch per task. A key whose sketches are all null or empty has an empty one.
    """
    hashes = parts.select(*keys, F.explode_outer("sketch").alias("hash")).distinct()
    present = F.col("hash").isNotNull()
    lowest = top_k(hashes, keys, [F.col("hash").asc_nulls_last()], size, ["hash"])
    return lowest.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(present, F.col("hash")))).alias("sketch"))


def _numbered(ids: DataFrame) -> DataFrame:
    """``ids (doc_id, mark, n)`` with ``at``, rising by descending id, and ``next_at`` of the next row; after the last comes the first.

    Rows are sorted in ranges and stored. Inside a range the next number is one more; only the first and last numbers of
    the ranges, one row each, are put in order together.
    """
    order = [F.col("doc_id").desc_nulls_last(), "mark"]
    ids = cut_lineage(ids.distinct().orderBy(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", _PART_BITS)
    ranges = ids.groupBy(part.alias("part")).agg(F.min("at").alias("low"), F.max("at").alias("high"))
    ordered = Window.orderBy("part")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select("high", F.coalesce(F.lead("low").over(ordered), F.min("low").over(whole)).alias("follow"))
    at_end = ids.join(F.broadcast(ranges), ids["at"] == ranges["high"], "left")
    return at_end.select("doc_id", "mark", "n", "at", F.coalesce("follow", F.col("at") + 1).alias("next_at"))


def edited_by_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, width: int = WIDTH) -> DataFrame:
    """Rows ``(doc_id, n_chars, text, edited, next_sketch)``, one per row of ``df``.

    ``edited`` is the text with its last ``floor(n_chars / 2)`` code points replaced by the first as many, or all, of the
    next document by descending id (after the last: the first); ``next_sketch`` is that document's sketch.

    Which document is next is worked out on ids alone. Texts are dealt by id once; what a document needs of the next
    one, at most half of its own length, is sent to it with the sketch.

    Null texts are empty. Null ids come last. Rows with an equal id are ordered by a hash of the text; rows equal in both are
    one document with one result each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("mark"))
    n = F.length("text").cast("bigint")

    ids = _numbered(docs.select("doc_id", "mark", n.alias("n")))
    ids = cut_lineage(ids.withColumn("id", F.coalesce("doc_id", F.lit(0))))
    docs = docs.drop("doc_id")  # it comes with the ids: both joins read the same columns, so texts are dealt once
    wants = ids.select(F.col("next_at").alias("at"), F.col("doc_id"), F.col("id").alias("to_id"), F.col("mark").alias("to_mark"), F.floor(F.col("n") / 2).cast("int").alias("give"))
    wants = ids.select("at", "id", "mark").join(wants, "at").drop("at")

    gives = docs.join(wants, ["id", "mark"]).select("id", "mark", "doc_id", "to_id", "to_mark", "text", F.left("text", F.col("give")).alias("head"))
    gives = gives.groupBy("id", "mark").agg(*[F.first(c).alias(c) for c in ("doc_id", "to_id", "to_mark", "text", "head")])  # repeated rows give once
    packed = F.unhex(F.array_join(sketch(F.col("text"), size, width), "")).alias("next_hashes")
    gives = gives.select("doc_id", F.col("to_id").alias("id"), F.col("to_mark").alias("mark"), "head", packed)

    own = F.left("text", n - F.floor(n / 2))
    joined = docs.join(gives, ["id", "mark"]).select("doc_id", n.alias("n_chars"), "text", F.concat(own, "head").alias("edited"), "next_hashes")
    return joined.select("doc_id", "n_chars", "text", "edited", unpacked(F.lower(F.hex("next_hashes"))).alias("next_sketch"))


def unpacked(digits: Column) -> Column:
    """Sketch from its hashes written one after another."""

    def cut(all_digits: Column) -> Column:
        n = (F.length(all_digits) / DIGITS).cast("int")
        places = F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), 1, n)
        return F.transform(places, lambda i: F.substring(all_digits, i * DIGITS + 1, F.lit(DIGITS)))

    return let(digits, cut)
