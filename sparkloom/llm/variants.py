"""Spelling variants: words one edit apart, found by bitsets per position and letter."""

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.operators.scale import cut_lineage, hinted, settle

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10

# Most words of one group; larger groups are split into finer ones.
GROUP = 4096

# Letters a-z and U+00C0 to U+00FF of lower-cased UTF-8; the latter are \xC3 and one more byte.
_LETTERS = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")

# Words counted before their counts leave a task.
_COUNTED = 200_000


def _counts(alter: Callable[[int | None, bytes], bytes] | None):
    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
                runs = _LETTERS.findall((text.as_py() or b"").lower())  # bytes: only A-Z change
                if alter is None:
                    counts.update(runs)
                else:
                    doc_id = doc_id.as_py()
                    for word, n in Counter(runs).items():
                        counts[alter(doc_id, word)] += n
                if len(counts) > _COUNTED:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    return run


def letter_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", alter: Callable[[int | None, bytes], bytes] | None = None) -> DataFrame:
    """Rows ``(word, n)``: maximal runs of letters (A-Z lower-cased, U+00C0 to U+00FF) of all texts with their number.

    ``alter`` may change a run (UTF-8) by the id of its document before it is counted. Tasks count what they read, so the
    shuffle carries a word once per task or once per 200,000 words of it. Null texts have no words.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_counts(alter), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class LetterIndex:
    """Bitsets over a list of words: which of them have a letter at a position.

    ``long`` words have ``size`` letters, ``short`` ones one less. Both searches walk along a word once and keep two sets:
    ``same`` has the words without an error so far, the others those with one error, whose next letter is looked up at
    the same position (a replaced letter), one before (the word lacks one) or one after (it has one more). The error is the
    first letter that differs, and counts only at a position from ``low`` to ``high - 1``.
    """

    def __init__(self, words: list[str], size: int, low: int, high: int):
        self.size, self.low, self.high = size, low, high
        self.at: list[dict[str, int]] = [{} for _ in range(size + 1)]
        self.long = self.short = 0
        for k, word in enumerate(words):
            bit = 1 << k
            if len(word) == size:
                self.long |= bit
            else:
                self.short |= bit
            for letters, c in zip(self.at, word):
                letters[c] = letters.get(c, 0) | bit

    def near_long(self, word: str) -> int:
        """Words with one letter of ``word`` replaced or left out."""
        same, replaced, less, before = self.long | self.short, 0, 0, {}
        for i, c in enumerate(word):
            here = self.at[i].get(c, 0)
            replaced &= here
            less &= before.get(c, 0)
            if self.low <= i < self.high:
                differ = same & ~here
                replaced |= differ & self.long
                less |= differ & self.short
            same &= here
            before = self.at[i]
        return replaced | less

    def near_short(self, word: str) -> int:
        """Words with one letter more than ``word``."""
        same, more = self.long, 0
        for i, c in enumerate(word):
            here, after = self.at[i].get(c, 0), self.at[i + 1].get(c, 0)
            more &= after
            if self.low <= i < self.high:
                more |= same & ~here & after
            same &= here
        return more | same if self.high == self.size else more


def _near_in_group(size: int, low: int, high: int, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """``(word, number of near words, count and text of the most frequent)`` for words that have any."""
    members.sort(key=lambda m: (-m[1], m[0]))
    index = LetterIndex([w for w, _ in members], size, low, high)
    if not index.long:
        return
    for word, _ in members:
        near = index.near_long(word) if len(word) == size else index.near_short(word)
        if near:
            best = members[(near & -near).bit_length() - 1]  # the lowest bit, as members are in this order
            yield word, near.bit_count(), best[1], best[0]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of sorted groups, one group in memory at a time."""

    def batch_of(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
        words, near, counts, best = zip(*rows) if rows else ((), (), (), ())
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip((words, near, counts, best), kinds)], names=["word", "n_near", "best_n", "best"])

    current, members, rows = None, [], []
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("key", "size", "low", "high", "word", "n")]
        for key, size, low, high, word, n in zip(*columns):
            if (key, size, low, high) != current:
                if len(members) > 1:
                    rows += _near_in_group(*current[1:], members)
                current, members = (key, size, low, high), []
                if len(rows) > 10_000:
                    yield batch_of(rows)
                    rows = []
            members.append((word, n))
    if len(members) > 1:
        rows += _near_in_group(*current[1:], members)
    yield batch_of(rows)


def _keyed(pieces: DataFrame) -> DataFrame:
    """``key`` of a word in the group of words of ``size`` letters that agree outside of a piece, the short ones shifted."""
    rest = F.col("high") + 1 - (F.col("size") - F.length("word"))
    outside = F.left("word", F.col("low")), F.substring("word", rest, F.length("word"))
    return pieces.withColumn("key", F.xxhash64("size", "low", "high", *outside))


def _halves(low: Column, high: Column) -> Column:
    middle = F.floor((low + high) / 2).cast("int")
    return F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high")))


def grouped(words: DataFrame, most: int = GROUP) -> DataFrame:
    """Rows ``(word, n, size, low, high, key)``: the groups in which a word meets its near words.

    Two words one edit apart, the longer of ``size`` letters, first differ in one half of ``size`` and agree outside of
    it, so they share the key of that half: every pair meets in exactly one group. A group over ``most`` words is
    split by halving the piece, again and again; pieces of one letter end it, as words that agree outside of one letter are no
    more than there are letters.
    """
    length = F.length("word")
    sizes = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    pieces = sizes.select("*", F.explode(_halves(F.lit(0), F.col("size"))).alias("piece")).select("word", "n", "size", "piece.*")
    members = _keyed(pieces)
    ready = []
    while True:
        counts = members.filter(F.col("high") - F.col("low") > 1).groupBy("key", "size", "low", "high").count()
        hot, small = settle(counts.filter(F.col("count") > most).select("key", "size", "low", "high"))
        if hot.isEmpty():
            break
        on = ["key", "size", "low", "high"]
        ready.append(members.join(hinted(hot, small), on, "left_anti"))
        split = members.join(hinted(hot, small), on, "left_semi")
        split = split.select("word", "n", "size", F.explode(_halves(F.col("low"), F.col("high"))).alias("piece"))
        members = cut_lineage(_keyed(split.select("word", "n", "size", "piece.*")))
    for part in ready:
        members = members.unionByName(part)
    return members


def near_words(words: DataFrame, most: int = GROUP) -> DataFrame:
    """Rows ``(word, n_near, best_n, best)`` for words of ``words (word, n)`` that have near words.

    ``best`` is the near word of largest ``n``, the smallest of equal ones. Groups of at most ``most`` words are indexed one
    by one; their results are one row per word and group, never pairs.
    """
    dealt = grouped(words, most).repartition("key").sortWithinPartitions("key", "size", "low", "high")
    found = dealt.mapInArrow(_near, "word string, n_near bigint, best_n bigint, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("best_n"), "best")).alias("first")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    return found.select("word", "n_near", (-F.col("first.best_n")).alias("best_n"), F.col("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """Rows ``(word, root)`` of ``forms (word, form)``: the end of the chain of forms, by jumping twice as far each round.

    Counts grow along a chain by a factor, so chains are short and have no circles.
    """
    jumps = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        far = jumps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        jumps = jumps.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        jumps = cut_lineage(jumps)
        if jumps.filter("moved").isEmpty():
            return jumps.select("word", "root")
        jumps = jumps.select("word", "root")


def spelling_variants(counts: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, most: int = GROUP) -> DataFrame:
    """Rows ``(word, form, root, n, n_near, form_n)``, one per word of ``counts (word, n)`` that is long and frequent enough.

    Two words are near if they differ by one inserted, deleted or replaced code point. ``form`` is the near word of largest
    ``n`` (ties: the smallest in code-point order) if that is ``ratio`` times the word's own or more, else null; ``root``
    is the last word along the forms.

    Repeated words count together; null words and counts are left out. No words give no rows. Words of any length are
    taken; other columns are not looked at.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    words = counts.filter(F.col("word").isNotNull() & (F.length("word") >= least_length)).groupBy("word").agg(F.sum("n").alias("n"))
    words = cut_lineage(words.filter(F.col("n") >= least_count))
    near = near_words(words, most)
    strong = F.col("best_n") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("best")).alias("form"),
        F.when(strong, F.col("best_n")).alias("form_n"),
    )
    judged = cut_lineage(judged)
    ends = roots(judged.filter(F.col("form").isNotNull()).select("word", "form"))
    joined = judged.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
