"""Near-duplicate groups: one-permutation MinHash, banded buckets, star edges, exact confirmation."""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.llm.common import connected, mix, ngram_hashes, word_hashes
from sparkloom.operators.scale import cut_lineage, hot_of_counts, per_salt, salted

WORDS = 5
# Partners of one document that one task compares with it; each is a comparison of two whole sets.
HUB = 250

# Size of the bitmap that tells dissimilar sets apart before they are compared; a power of two.
BITMAP_LONGS = 32


@dataclass(frozen=True)
class Banding:
    """Bins of the one permutation (a power of two), cut into bands of ``rows`` bins.

    A pair at similarity s meets in no band with probability ``(1 - s**rows) ** bands``;
    128 bins in bands of 4 make that 5e-6 at 0.75.
    """

    bins: int = 128
    rows: int = 4

    def __post_init__(self):
        if self.bins & (self.bins - 1) or self.bins % self.rows:
            raise ValueError("bins must be a power of two and a multiple of rows")


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct five-word shingles of a text with A-Z lower-cased.

    Fewer than five words are one shingle as a whole; no words give an empty set.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    return np.unique(ngram_hashes(word_hashes(words), WORDS))


def _probes(bins: int) -> np.ndarray:
    """For every bin the order in which an empty one asks the others: a fixed shuffle per bin."""
    key = mix(np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins) + np.uint64(1))
    return np.argsort(key, axis=1, kind="stable")


def signature(shingles: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """Smallest hash in each bin; an empty bin borrows from the first filled bin in its own order.

    The upper bits of a hash choose the bin, so in the sorted set each bin is one run.
    """
    width = np.uint64(64 - (bins.bit_length() - 1))
    first = np.searchsorted(shingles, np.arange(bins, dtype=np.uint64) << width)
    filled = np.append(first[1:], len(shingles)) > first
    source = np.arange(bins)
    empty = np.flatnonzero(~filled)
    source[empty] = probes[empty, np.argmax(filled[probes[empty]], axis=1)]
    return shingles[first[source]]


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    grouped = sig.reshape(-1, rows)
    key = np.arange(len(grouped), dtype=np.uint64)
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, k])
    return key


def _sketch(banding: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = _probes(banding.bins)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            sizes, sets, bands = [], [], []
            for text in texts:
                s = shingle_set(text.as_py())
                sizes.append(len(s))
                sets.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                bands.append(band_keys(signature(s, banding.bins, probes), banding.rows).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(sets, pa.string()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_hash", "bands"],
            )

    return run


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """``BITMAP_LONGS`` longs with a bit for every hash; a bit that one set has and another lacks is a hash that is not in both."""
    bits = np.zeros(64 * BITMAP_LONGS, np.uint8)
    bits[shingles & np.uint64(64 * BITMAP_LONGS - 1)] = 1
    return np.packbits(bits).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        sets = [shingle_set(text.as_py()) for text in texts]
        columns = [[s.view(np.int64) for s in sets], [bitmap(s) for s in sets]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.list_(pa.int64())) for c in columns)], names=["doc_id", "shingles", "bits"])


def _similar(both: Column, n: Column, m: Column, percent: int) -> Column:
    """Exact test on set sizes: ``100 * both >= percent * union``."""
    return 100 * both >= percent * (n + m - both)


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    """Sets whose sizes differ more cannot reach the similarity."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``(a, b)`` whose whole sets are similar.

    The side that repeats less (``b``) brings its set first. A hub (``a``) with many partners meets them in several
    tasks: partners are counted on ids alone, spread over salts, and the hub's set is sent once per salt.
    """
    pairs = cut_lineage(pairs)
    hot = hot_of_counts(pairs.groupBy("a").agg(F.count("*").alias("n")), ["a"], "n", HUB)
    spread = salted(pairs, ["a"], ["b"], *hot)
    with_b = spread.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    sets_a = per_salt(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), ["a"], *hot)
    with_both = with_b.join(sets_a, ["a", "_salt"])
    both = F.size(F.array_intersect("set_a", "set_b"))
    return with_both.filter(_similar(both, F.size("set_a"), F.size("set_b"), percent)).select("a", "b").distinct()


def _residual(crowded: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that the stars left in different components.

    Such pairs are compared inside the join, so only links come out of it. Bitmaps come
    first: they bound from below what one set has and the other lacks. Then the sets as
    32-bit hashes; what those lose by chance inside a set is added back. So neither turns a
    link away, and what passes is confirmed on whole sets.
    Buckets in one component, the usual case for groups of copies, do not take part.
    """
    placed = crowded.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
    placed = cut_lineage(placed.select("key", "rep", "n", F.coalesce("component", "rep").alias("component")))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    short = F.array_distinct(F.transform("shingles", lambda h: F.shiftright(h, 32).cast("int")))
    members = placed.join(mixed, "key").join(sets.select(F.col("doc_id").alias("rep"), short.alias("short"), "bits"), "rep")
    members = cut_lineage(members)
    x, y = members.alias("x"), members.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    lost = F.least(n - F.size("x.short"), m - F.size("y.short"))
    both = F.size(F.array_intersect("x.short", "y.short")) + lost

    def missing(one: str, other: str) -> Column:
        words = [F.bit_count(F.get(F.col(f"{one}.bits"), F.lit(k)).bitwiseAND(F.bitwise_not(F.get(F.col(f"{other}.bits"), F.lit(k))))) for k in range(BITMAP_LONGS)]
        return reduce(Column.__add__, words)

    met = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.rep") < F.col("y.rep"))
        & (F.col("x.component") != F.col("y.component"))
        & _sizes_fit(n, m, percent)
        & _similar(n - missing("x", "y"), n, m, percent)
        & _similar(m - missing("y", "x"), n, m, percent)
        & _similar(both, n, m, percent)
    )
    pairs = x.join(y, met).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    return _confirmed(pairs, sets, percent)


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, banding: Banding = Banding()) -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id, kept)``, one per row of ``df``.

    Documents link when the Jaccard similarity of their shingle sets is at least ``percent``;
    ``component_id`` is the smallest id reachable over links and ``kept`` says that it is
    the document's own.

    1. One pass makes a set hash and the band keys; copies (equal sets) shrink to their
       smallest id before anything meets in a bucket.
    2. Every bucket is a star: its smallest id is joined to the others, after a minimum
       with partial sums. Edges are confirmed on whole sets.
    3. A bucket whose members are not yet in one component may hold links that do not
       touch its smallest id; ``_residual`` finds those.

    Null and empty texts, and texts without words, have size 0, link with nothing and are
    kept. Null ids have a null component and are kept. Rows that repeat an id are each
    judged by their own text. Ties have no influence: only the smallest id counts. Other
    columns are not looked at.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = cut_lineage(docs.mapInArrow(_sketch(banding), "doc_id bigint, n_shingles bigint, set_hash string, bands array<bigint>"))

    known = F.col("set_hash").isNotNull() & F.col("doc_id").isNotNull()
    heads = cut_lineage(sketched.filter(known).groupBy("set_hash").agg(F.min("doc_id").alias("head")))
    own = (sketched["set_hash"] == heads["set_hash"]) & (sketched["doc_id"] == heads["head"])
    leads = sketched.join(heads, own).groupBy(F.col("head").alias("rep"), heads["set_hash"])
    reps = leads.agg(F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    buckets = cut_lineage(reps.select("rep", "n", F.explode("bands").alias("key")))
    centers = buckets.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last"), F.min_by("n", "rep").alias("center_n"))
    crowded = cut_lineage(buckets.join(centers.filter(F.col("center") < F.col("last")), "key").select("key", "rep", "n", "center", "center_n"))
    spokes = crowded.filter((F.col("rep") != F.col("center")) & _sizes_fit(F.col("n"), F.col("center_n"), percent))
    stars = spokes.select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    candidates = crowded.select(F.col("rep").alias("doc_id")).distinct()
    sets = cut_lineage(docs.join(candidates, "doc_id").mapInArrow(_sets, "doc_id bigint, shingles array<bigint>, bits array<bigint>"))
    links = cut_lineage(_confirmed(stars, sets, percent))
    groups = connected(links)
    more = cut_lineage(_residual(crowded, groups, sets, percent))
    if not more.isEmpty():
        groups = connected(links.union(more))

    grouped = heads.join(groups, F.col("head") == F.col("node"), "left")
    grouped = grouped.select("set_hash", F.coalesce("component", "head").alias("component_id"))
    named = sketched.select("doc_id", "n_shingles", "set_hash").join(grouped, "set_hash", "left")
    named = named.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return named.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``df`` with all their columns, one document per group.

    The document with the group's smallest id stays; of rows that repeat its id, the first
    by the hash of the whole row. Rows without an id stay.
    """
    groups = near_groups(df, id_col, text_col, **options)
    kept = groups.filter(F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id")).distinct()
    whole = df.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(*df.columns).alias("hash"), F.struct(*df.columns).alias("row"))
    first = Window.partitionBy("id").orderBy("hash")
    one = whole.join(kept, "id").withColumn("rank", F.row_number().over(first)).filter("rank = 1").select("row.*")
    return one.unionByName(df.filter(F.col(id_col).isNull()))
