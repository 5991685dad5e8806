"""What the operators share: words, hashes, tables in the shared folder, components of a graph."""

import sys

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkloom.operators.scale import cut_lineage

# Functions that run on executors travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["sparkloom"])

# A word is a run of characters other than space and \t \n \v \f \r; bytes.split() cuts at the same six.
WORD_GAP = r"[\x20\x09-\x0D]+"

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_words(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` (at most five) words."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        out += hashes[k : len(hashes) - n + 1 + k] * _MULTIPLIERS[k]
    return mix(out)


def connected(edges: DataFrame) -> DataFrame:
    """Rows ``(node, component)``, the component being the smallest node reachable.

    ``edges`` has ``a`` and ``b``. Every round takes the smallest label of a node's
    neighbours (a minimum with partial sums, so a hub is one row per task) and then the
    label of that label, which halves the remaining depth. Rounds are cut by tables in the
    shared folder; a lost executor repeats one round at most.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("at")).agg(F.min("component").alias("low"))
        lower = labels.join(near, F.col("node") == F.col("at")).select("node", F.least("component", "low").alias("next"), "component")
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("far"))
        after = lower.join(jump, F.col("next") == F.col("to")).select("node", F.least("next", "far").alias("component"), (F.least("next", "far") != F.col("component")).alias("changed"))
        after = cut_lineage(after)
        labels = after.select("node", "component")
        if after.filter("changed").isEmpty():
            return labels
