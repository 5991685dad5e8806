import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import queries, runs


def brute(words, repeats=4, shortest=6):
    """Every stretch of every period, grown as far as it goes; those with a smaller period of their own are left out."""
    found = set()
    for p in range(1, len(words) // repeats + 1):
        start = 0
        while start + p < len(words):
            end = start
            while end + p < len(words) and words[end] == words[end + p]:
                end += 1
            length = end - start + p
            if end > start and length >= max(shortest, repeats * p):
                part = words[start : start + length]
                if not any(all(part[i] == part[i + q] for i in range(length - q)) for q in range(1, p)):
                    found.add((start, length, p))
            start = max(end, start) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, n=150):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.randint(0, 3)
            if kind == 0:
                words += rng.choices("abc", k=rng.randint(1, 40))
            elif kind == 1:
                period = rng.choices("abcdefg", k=rng.randint(1, 9))
                words += (period * 12)[: rng.randint(1, 9 * len(period))]
            elif kind == 2:
                words += [f"u{rng.randint(0, 9)}" for _ in range(rng.randint(0, 20))]
            else:
                words += rng.choice([["x"] * rng.randint(1, 30), ["x", "x", "y"] * rng.randint(1, 9), (["a", "a", "b"] * 5 + ["c"]) * rng.randint(2, 6)])
        out.append(words)
    return out


@pytest.mark.parametrize(("repeats", "shortest"), [(4, 6), (3, 1), (5, 20)])
def test_runs_equal_brute_force(documents, repeats, shortest):
    made = texts(repeats)
    df = documents([(i, " \n".join(words)) for i, words in enumerate(made)])
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"], r["n_words"]) for r in runs.periodic_runs(df, repeats=repeats, shortest=shortest).collect()}
    for i, words in enumerate(made):
        want = brute(words, repeats, shortest)
        assert got[i] == (want, collapsed(words, want), len(words))


def test_splitting_loses_no_run():
    for words in texts(9, 60):
        ids = np.array([hash(w) % 1000 for w in words], np.int64)
        for start, n, _ in brute(ids.tolist()):
            assert any(a <= start and start + n <= b for a, b in runs.surviving(ids, np.array([0, len(ids)])))


def test_splitting_is_stable_and_per_text():
    ids = np.array([1, 2, 1, 2, 1, 2, 1, 2, 9, 3, 3, 3] + [3, 3, 3, 5, 5, 5], np.int64)
    assert runs.surviving(ids, np.array([0, 12, 18])) == [(0, 8)]
    # A cascade: each part that is cut off makes the next word too rare.
    for blocks, left in ((40, False), (300, True)):
        cascade = np.array([w for k in range(blocks, 0, -1) for w in (k, k - 1, k, k)], np.int64)
        segments = runs.surviving(cascade, np.array([0, len(cascade)]))
        assert bool(segments) == left and all(runs.lag_scan(cascade[a:b]) == [] for a, b in segments)


def test_long_texts_take_few_steps(documents):
    long = [f"w{k % 7}" for k in range(200_000)] + ["end"] + ["x"] * 100_000
    mixed = [str(zlib.crc32(b"%d" % (k % 5000)) % 50) for k in range(25_000)]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in runs.periodic_runs(documents([(1, " ".join(long)), (2, " ".join(mixed))])).collect()}
    assert got[1] == [(0, 200_000, 7), (200_001, 100_000, 1)]
    assert (0, 25_000, 5000) in got[2]


def test_odd_rows(documents, odd_texts):
    rows = runs.periodic_runs(documents([*odd_texts, (11, "z " * 6), (12, "z " * 5)])).collect()
    assert len(rows) == len(odd_texts) + 2
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["runs"] == [] and by_id[1]["collapsed"] == "" and by_id[3]["n_words"] == 0
    assert [tuple(x) for x in by_id[11]["runs"]] == [(0, 6, 1)] and by_id[11]["collapsed"] == "z"
    assert by_id[12]["runs"] == [] and by_id[None]["collapsed"] == "no id"
    assert runs.periodic_runs(documents([(1, "a")]).limit(0)).count() == 0


def test_looped_texts_follow_the_rule(documents):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 41))) for i in range(300)] + [(None, "a b"), (7, None)]
    got = dict(queries.with_loops(documents(rows[:300])).collect())
    for i, text in rows[:300]:
        words, h = text.split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            a, n = h // 10 % len(words), len(words)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        assert got[i].split() == words
    assert queries.with_loops(documents(rows[300:])).filter(F.col("text").isNull()).count() == 1


def test_ties_go_to_the_first_run(spark, tmp_path, documents):
    text = "a " * 8 + "b " + "c " * 8 + "d " + "e f " * 8
    documents([(1, text), (2, "none here")]).write.parquet(str(tmp_path / "documents.parquet"))
    by_id = {r["doc_id"]: r for r in queries.op11_runs(spark, str(tmp_path)).collect()}
    if zlib.crc32(b"1") % 10:
        assert (by_id[1]["n_runs"], by_id[1]["start"], by_id[1]["length"], by_id[1]["period"], by_id[1]["exponent_milli"]) == (3, 0, 8, 1, 8000)
    assert by_id[2]["n_runs"] == 0 and by_id[2]["start"] is None and by_id[2]["exponent_milli"] is None
