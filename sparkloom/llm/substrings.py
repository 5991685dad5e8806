"""Exact repeated passages: rolling hashes of every window of words, counted in Spark."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.common import mix, word_hashes
from sparkloom.operators.scale import cut_lineage, hot_of_counts, per_salt, salted

WINDOW = 50

# Rows of one value that are left to one task.
HOT = 2000

# Odd bases of two independent rolling hashes modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` words, spread over 64 bits.

    The base is odd, so it has an inverse modulo 2^64: with words scaled by falling powers
    every run is the difference of two running sums, scaled back.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    falling = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    rising = np.full(n, base, np.uint64)
    falling[0] = rising[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(falling), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * np.cumprod(rising)[width - 1 :])


def window_anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every window the smallest hash among the half-windows inside it.

    Equal windows have equal anchors, and neighbours mostly share theirs, so a text has
    far fewer anchors than windows.
    """
    half = window // 2
    low = rolling(hashes, half, _BASES[0])
    span, done = window - half + 1, 1
    if len(low) < span:
        return np.zeros(0, np.uint64)
    while done < span:
        step = min(done, span - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    return low


def merge_windows(places: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal word intervals, end exclusive, that windows at sorted ``places`` cover."""
    if not len(places):
        return []
    breaks = np.flatnonzero(np.diff(places) > window)
    starts = places[np.append(0, breaks + 1)]
    ends = places[np.append(breaks, len(places) - 1)] + window
    return list(zip(starts.tolist(), ends.tolist()))


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _sequence(words: list[bytes]) -> str:
    return xxhash.xxh3_128_hexdigest(b" ".join(words))


_SCANNED = "doc_id bigint, n_words bigint, sequence string, digest string, anchors array<bigint>"
_PASSAGES = "doc_id bigint, sequence string, text string, anchors array<bigint>"
_WINDOWS = "doc_id bigint, sequence string, places array<int>, first array<bigint>, second array<bigint>"
_CHANGED = "doc_id bigint, sequence string, spans array<struct<start:int,end:int>>, digest string"


def _scan(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sequences, digests, anchors = [], [], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                words = (text.as_py() or b"").split()
                sizes.append(len(words))
                sequences.append(_sequence(words))
                digests.append(_digest(words))
                found = window_anchors(word_hashes(words), window) if len(words) >= window else np.zeros(0, np.uint64)
                anchors.append(np.unique(found).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sequences, pa.string()), pa.array(digests, pa.string()), pa.array(anchors, pa.list_(pa.int64()))],
                names=["doc_id", "n_words", "sequence", "digest", "anchors"],
            )

    return run


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is the one that the sequence names; others meet by a shared id only."""
    for batch in batches:
        texts, sequences = batch.column("text").cast(pa.large_binary()), batch.column("sequence")
        own = [_sequence((t.as_py() or b"").split()) == s.as_py() for t, s in zip(texts, sequences)]
        yield batch.filter(pa.array(own, pa.bool_()))


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, first, second = [], [], []
            for text, anchors in zip(batch.column("text").cast(pa.large_binary()), batch.column("anchors")):
                hashes = word_hashes(text.as_py().split())
                wanted = anchors.values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = np.flatnonzero(np.isin(window_anchors(hashes, window), wanted))
                places.append(at.astype(np.int32))
                first.append(rolling(hashes, window, _BASES[0])[at].view(np.int64))
                second.append(rolling(hashes, window, _BASES[1])[at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("sequence"), pa.array(places, pa.list_(pa.int32())), pa.array(first, pa.list_(pa.int64())), pa.array(second, pa.list_(pa.int64()))],
                names=["doc_id", "sequence", "places", "first", "second"],
            )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans, digests = [], []
            for text, places in zip(batch.column("text").cast(pa.large_binary()), batch.column("places")):
                words = text.as_py().split()
                merged = merge_windows(np.sort(places.values.to_numpy(zero_copy_only=False)), window)
                spans.append([{"start": a, "end": b} for a, b in merged])
                digests.append(_digest(without(words, merged)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("sequence"), pa.array(spans, kind), pa.array(digests, pa.string())],
                names=["doc_id", "sequence", "spans", "digest"],
            )

    return run


def without(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    kept, at = [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    return kept + words[at:]


def _with_counts(rows: DataFrame, counts: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose value is in ``counts (*on, low, high, n)``, with ``low``.

    A passage of very many texts is one value with very many rows. How many is known from the count, so its rows
    are spread over salts and its count is sent once per salt.
    """
    counts = cut_lineage(counts.select(*on, "low", "n"))
    hot = hot_of_counts(counts, on, "n", HOT)
    return salted(rows, on, ["doc_id"], *hot).join(per_salt(counts.drop("n"), on, *hot), [*on, "_salt"]).drop("_salt")


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows ``(doc_id, n_words, spans, kept_sha256)``, one per row of ``df``.

    ``spans`` are maximal word intervals covered by windows of ``window`` words that also
    start in a document with a smaller id, judged on the input; ``kept_sha256`` is the digest
    of the other words, joined by one space.

    1. One pass gives every text its size, digest and anchors. Texts with the same words shrink to their
       smallest id; the others are covered whole when they have a window.
    2. Anchors are counted with partial sums. A window can only repeat if its anchor does, so all other
       windows are left out before anything is shuffled by window.
    3. The windows that remain are counted by two independent 64-bit hashes, and those
       whose first document is smaller are gathered per document and merged.

    A passage in very many texts is one row per task in both counts, and spread over salts in the joins that give
    counts back.

    Null and empty texts have no words. Null ids neither remove nor lose words. Rows that repeat
    an id do not remove each other's words. Other columns are not looked at.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    scanned = cut_lineage(docs.mapInArrow(_scan(window), _SCANNED))
    long = scanned.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    heads = long.groupBy("sequence").agg(F.min("doc_id").alias("head"))

    own = long.join(heads.withColumnRenamed("head", "doc_id"), ["sequence", "doc_id"])
    marks = own.select("doc_id", "sequence", F.explode("anchors").alias("anchor"))
    shared = marks.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).filter("low < high")
    wanted = _with_counts(marks, shared, ["anchor"]).groupBy("doc_id", "sequence").agg(F.collect_set("anchor").alias("anchors"))
    passages = docs.join(wanted, "doc_id").select("doc_id", "sequence", "text", "anchors")
    passages = cut_lineage(passages.mapInArrow(_own_text, _PASSAGES))

    arrays = passages.mapInArrow(_windows(window), _WINDOWS)
    rows = arrays.select("doc_id", "sequence", F.explode(F.arrays_zip("places", "first", "second")).alias("w"))
    rows = rows.select("doc_id", "sequence", F.col("w.places").alias("place"), F.col("w.first").alias("first"), F.col("w.second").alias("second"))
    counted = rows.groupBy("first", "second").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).filter("low < high")
    later = _with_counts(rows, counted, ["first", "second"]).filter(F.col("low") < F.col("doc_id"))
    places = later.groupBy("doc_id", "sequence").agg(F.collect_set("place").alias("places"))
    changed = passages.drop("anchors").join(places, ["doc_id", "sequence"]).mapInArrow(_cut(window), _CHANGED)
    changed = changed.dropDuplicates(["doc_id", "sequence"])

    facts = scanned.drop("anchors").join(heads, "sequence", "left")
    facts = facts.join(changed.withColumnRenamed("digest", "less"), ["doc_id", "sequence"], "left")
    copy = F.col("head") < F.col("doc_id")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return facts.select(
        "doc_id",
        "n_words",
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("less", "digest")).alias("kept_sha256"),
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").cast(pa.large_binary()), batch.column("spans")):
            cut = [(s["start"], s["end"]) for s in spans.as_py() or []]
            texts.append(b" ".join(without((text.as_py() or b"").split(), cut)).decode())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows ``(doc_id, text)`` with the repeated words taken out, for ids that are unique."""
    spans = repeated_spans(df, id_col, text_col, window).select("doc_id", "spans")
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.join(spans, "doc_id", "left").mapInArrow(_kept, "doc_id bigint, text string")
