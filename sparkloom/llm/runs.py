"""Runs of words that repeat with a period: segments are split by frequency, and lags scanned in what is left."""

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.common import mix

# A run holds its period this many times at least, and this many words.
REPEATS = 4
SHORTEST = 6

# Texts are worked on together up to this many bytes, so that numpy calls are few and memory stays bounded.
_TOGETHER = 2 << 20

# Splitting that goes on longer than this only shaves single words off; the lag scan takes such segments as they are.
_ROUNDS = 64

_BASE = 0x9E3779B97F4A7C15

_FOUND = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def surviving(words: np.ndarray, bounds: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Segments ``(start, end)`` of the texts between ``bounds`` that runs can be in, by recursive splitting.

    A word of a run stands in it ``repeats`` times or more. So a word that is rarer in its segment is in no run and splits
    the segment; its parts are counted anew, until no word is too rare. All segments of a round are counted by one sort.
    """
    place = np.arange(len(words))
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kinds = int(words.max(initial=0)) + 1
    done = []
    for _ in range(_ROUNDS):
        sizes = np.bincount(segment)
        long = sizes[segment] >= shortest if len(place) else np.zeros(0, bool)
        place, segment = place[long], segment[long]
        if not len(place):
            return done
        _, which, times = np.unique(segment * kinds + words[place], return_inverse=True, return_counts=True)
        often = times[which] >= repeats
        split = np.zeros(len(sizes), bool)
        split[segment[~often]] = True
        changed = split[segment]
        done += _ends(place[~changed], segment[~changed])
        place, segment = place[changed & often], segment[changed & often]
        breaks = np.ones(len(place), bool)
        breaks[1:] = (np.diff(place) != 1) | (np.diff(segment) != 0)
        segment = np.cumsum(breaks) - 1
    return done + _ends(place, segment)


def _ends(place: np.ndarray, segment: np.ndarray) -> list[tuple[int, int]]:
    first = np.flatnonzero(np.diff(segment, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    return list(zip(place[first].tolist(), (place[last] + 1).tolist())) if len(place) else []


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many entries are equal before the first that differs."""
    size, at, step = min(len(a), len(b)), 0, 32
    while at < size:
        end = min(at + step, size)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, step * 2
    return size


def lag_scan(words: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of one segment.

    A run of ``repeats`` periods holds ``repeats - 1`` whole blocks of any grid of its period's width, all equal. For
    every lag the blocks of the grid from 0 are compared by hash (differences of running sums): ``n / lag`` blocks, so all lags
    together take ``n log n`` steps. Where enough neighbours are equal, the words themselves are compared outwards. A place
    that a run of a shorter period covers that far is a multiple of it and is passed over.
    """
    n, base = len(words), np.uint64(_BASE)
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(words.astype(np.uint64) + base) * np.cumprod(powers), out=sums[1:])
    found, reach, power = [], np.zeros(n, np.int64), 1
    blocks = repeats - 1
    for lag in range(1, n // repeats + 1):
        power = power * _BASE % (1 << 64)
        sizes = np.diff(sums[::lag])
        equal = sizes[1:] == sizes[:-1] * np.uint64(power)
        hits = equal[: len(equal) - blocks + 2]
        for k in range(1, blocks - 1):
            hits = hits & equal[k : len(equal) - blocks + 2 + k]
        if not hits.any():
            continue
        starts = np.flatnonzero(hits) * lag
        measured = 0
        for at in starts[reach[starts] < starts + blocks * lag].tolist():
            if at + blocks * lag <= measured:
                continue
            measured = at + lag + _same(words[at:], words[at + lag :])
            start = at - _same(words[:at][::-1], words[lag : at + lag][::-1])
            if measured - start >= max(shortest, repeats * lag):
                found.append((start, measured - start, lag))
                np.maximum(reach[start:measured], measured, out=reach[start:measured])
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(kept).tolist()])


def _together(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of the texts, in groups of a bounded size; a longer text is a group of its own."""
    group, size = [], 0
    for text in texts:
        text = text.as_py() or b""
        if group and size + len(text) > _TOGETHER:
            yield group
            group, size = [], 0
        group.append(text.split())
        size += len(text)
    if group:
        yield group


def _scan(repeats: int, shortest: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def runs_of(group: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        number = defaultdict(count().__next__)
        bounds = np.cumsum([0, *map(len, group)])
        words = np.fromiter((number[w] for text in group for w in text), np.int64, int(bounds[-1]))
        runs: list[list[tuple[int, int, int]]] = [[] for _ in group]
        for start, end in surviving(words, bounds, repeats, shortest):
            at = int(np.searchsorted(bounds, start, "right")) - 1
            shift = start - int(bounds[at])
            runs[at] += [(s + shift, length, period) for s, length, period in lag_scan(words[start:end], repeats, shortest)]
        return [sorted(r, key=lambda x: (x[0], x[2])) for r in runs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, kept = [], [], []
            for group in _together(batch.column(1).cast(pa.large_binary())):
                for words, runs in zip(group, runs_of(group)):
                    sizes.append(len(words))
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    kept.append(_collapsed(words, runs).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: int = REPEATS, shortest: int = SHORTEST) -> DataFrame:
    """Rows ``(doc_id, n_words, runs, collapsed)``, one per row of ``df``.

    A run is a stretch of words with smallest period ``p`` (words ``p`` apart are equal), at least ``shortest`` words and
    ``repeats`` (three or more) times ``p`` long, that neither neighbour extends. ``runs`` has all of them by start and
    period; ``collapsed`` is the text without the words that a run covers after its first period, joined by one space.

    Each text is worked on in its own row: words too rare in their segment split it until none is, then lags are scanned in the
    segments that are left. Nothing is shuffled.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Repeated rows and ids, also null ones,
    are rows of their own. Other columns are not looked at.
    """
    if repeats < 3:
        raise ValueError("a run has three repeats at least")
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_scan(repeats, shortest), _FOUND)
