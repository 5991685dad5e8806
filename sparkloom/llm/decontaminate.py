"""Benchmark decontamination: spaced seeds join documents and benchmark items, overlaps are verified around hits."""

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.operators.scale import cut_lineage, lookup_join

# Whole items need this share of their tokens at the same offset, parts need HITS of SPAN.
SHARE = 0.8
SPAN, HITS = 20, 17
# Most tokens that a seed looks at.
WEIGHT = 4
# From this length on all items have the same masks.
_LONG = 32

# Seeds are broadcast up to this many rows of three numbers (about 30 MB as a hash table).
BROADCAST_SEEDS = 500_000
# Ids of contaminated documents are broadcast up to this many (8 bytes each).
BROADCAST_IDS = 1_000_000


def mask(weight: int, stride: int) -> str:
    """A mask of ``weight`` tokens, each ``stride`` after the one before; a substitution at any other position leaves a seed whole."""
    return "1" + ("0" * (stride - 1) + "1") * (weight - 1)


def differing(n: int) -> int:
    """How many of an item's ``n`` tokens may differ."""
    return n - math.ceil(SHARE * n - 1e-9)


def masks_of(n: int) -> tuple[str, ...]:
    """Masks that leave no overlap of an item of ``n`` tokens without a seed.

    ``s`` seeds of weight ``w`` and stride ``s`` that start one after another fill ``s * w`` neighbouring tokens and share none. Strides 2 and 3
    together fill every multiple of ``w`` from ``2 w`` on, so ``n`` tokens hold ``n // w`` seeds that share no token: if that is more than
    may differ, one of them is whole. One stride is used where it is enough. Any ``SPAN`` tokens hold four
    of weight 4 and stride 2, of which three differences leave one. Items of which no token may differ are one seed.
    """
    d = differing(n)
    if not d:
        return ("1" * min(n, WEIGHT),)
    weight = next(w for w in range(WEIGHT, 0, -1) if n // w > max(d, 1))
    for stride in (2, 3):
        if stride * (n // (stride * weight)) > d:
            return (mask(weight, stride),)
    return mask(weight, 2), mask(weight, 3)


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seed(words: Column, at: Column, mask: str) -> Column:
    """Hash of the masked tokens from ``at`` on, null where the mask runs over the end."""
    picked = [F.get(words, at + k) for k, c in enumerate(mask) if c == "1"]
    return F.when(at + len(mask) <= F.size(words), F.xxhash64(F.lit(mask), *picked))


def _seeds(df: DataFrame, masks: list[str], at: str) -> DataFrame:
    """One row per token position and mask: the row's columns, ``at`` and ``seed``."""
    shortest = min(len(m) for m in masks)
    last = F.size("words") - shortest
    places = df.withColumn(at, F.explode(F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))))
    seeds = F.array(*[_seed(F.col("words"), F.col(at), m) for m in masks])
    return places.withColumn("seed", F.explode(seeds)).filter(F.col("seed").isNotNull())


def _verified(hits: DataFrame) -> DataFrame:
    """Hits whose overlap holds: rows ``(doc_id, item_id, start, matched, n_tokens)``.

    The item is laid over the document at the hit's offset; tokens beyond the document's ends do not match.
    """
    start, n = F.col("at") - F.col("item_at"), F.size("item_words")
    same = F.transform("item_words", lambda w, k: F.coalesce(F.get(F.col("words"), F.col("_start") + k) == w, F.lit(False)))
    laid = hits.withColumn("_start", start).withColumn("_same", same)
    matched = F.size(F.filter("_same", lambda x: x))
    part = F.exists(
        F.sequence(F.lit(1), F.greatest(n - SPAN + 1, F.lit(1))),
        lambda k: F.size(F.filter(F.slice("_same", k, SPAN), lambda x: x)) >= HITS,
    )
    held = laid.filter((matched >= SHARE * n) | ((n > SPAN) & part))
    return held.select("doc_id", "item_id", F.col("_start").alias("start"), matched.alias("matched"), n.alias("n_tokens"))


def contaminated(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    masks: Callable[[int], tuple[str, ...]] = masks_of, broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """Rows ``(doc_id, item_id, start, matched, n_tokens)``, one per document and item it holds.

    An item is held when a seed meets and, at that offset, ``SHARE`` of the item's tokens are
    equal or some ``SPAN`` tokens of it have ``HITS`` equal ones. Of several places the one with
    most matches counts, then the first. ``masks`` gives the spaced seeds of an item by its length; by default every
    overlap that holds has a whole one.

    The seeds of the benchmark are counted. Up to ``broadcast_seeds`` rows they go to the documents,
    whose windows are hashed, probed and verified in one stage: only verified overlaps are shuffled. Beyond, windows are
    joined by seed, the windows of a frequent seed spread over salts, and the texts fetched for hits.

    Null and empty texts and items hold nothing. Rows with a null id or item id are left
    out. Rows that repeat an id are one document that holds what any of them holds. Other columns are not looked at.
    """
    docs = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), tokens(F.col(text_col)).alias("words"))
    items = benchmark.filter(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), tokens(F.col(item_text_col)).alias("words"))
    items = cut_lineage(items.filter(F.size("words") > 0).distinct())

    length = F.least(F.size("words"), F.lit(_LONG))
    users: dict[str, list[int]] = {}
    for r in items.select(length.alias("n")).distinct().collect():  # at most _LONG rows
        for m in masks(r["n"]):
            users.setdefault(m, []).append(r["n"])
    if not users:
        users = {"1": [0]}
    parts = [_seeds(items.filter(length.isin(lengths)), [m], "item_at") for m, lengths in sorted(users.items())]
    seeds = cut_lineage(reduce(DataFrame.unionByName, parts).select("seed", "item_id", "item_at").distinct())
    item_words = items.withColumnRenamed("words", "item_words")

    windows = _seeds(docs, sorted(users), "at")
    if seeds.count() <= broadcast_seeds:
        hits = windows.join(F.broadcast(seeds), "seed").join(F.broadcast(item_words), "item_id")
    else:
        met = lookup_join(windows.select("doc_id", "at", "seed"), seeds, ["seed"], ["doc_id", "at"], "inner")
        met = met.select("doc_id", "item_id", F.expr("at - item_at").alias("at")).distinct().withColumn("item_at", F.lit(0))
        hits = met.join(docs, "doc_id").join(item_words, "item_id")
    best = F.max_by(F.struct("start", "matched", "n_tokens"), F.struct("matched", -F.col("start")))
    return _verified(hits).groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.start", "b.matched", "b.n_tokens")


def without_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` that hold no benchmark item, with all columns; rows without an id stay."""
    ids = cut_lineage(contaminated(df, benchmark, id_col, text_col).select("doc_id").distinct())
    small = ids.count() <= BROADCAST_IDS
    whole = df.select(F.col(id_col).alias("doc_id"), F.struct(*df.columns).alias("row"))
    return whole.join(F.broadcast(ids) if small else ids, "doc_id", "left_anti").select("row.*")
