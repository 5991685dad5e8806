import random

import pytest

from pyspark.sql import functions as F

from sparkloom.llm import near_dedup
from sparkloom.llm.common import connected


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    top = {i: i for i, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(rows[a][0]), find(rows[b][0])
                top[max(x, y)] = min(x, y)
    return {(i, len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets)}


def varied(rng, base, share):
    return " ".join(w if rng.random() > share else f"z{rng.randint(0, 10**6)}" for w in base.split())


def test_components_equal_brute_force(documents):
    rng = random.Random(4)
    bases = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(n)) for n in (12, 40, 90, 200, 400)]
    rows = [(7 * k + 3, varied(rng, bases[k % 5], rng.choice((0, 0.01, 0.02, 0.03, 0.05)))) for k in range(400)]
    rows += [(5000 + k, t) for k, t in enumerate(["", None, " \n", "One two", "one TWO", "one two three four", "É é", "é é"])]
    rng.shuffle(rows)
    got = {tuple(r) for r in near_dedup.near_groups(documents(rows)).collect()}
    assert got == brute(rows)
    assert len({g[2] for g in got}) < 300  # copies and links there are


def test_links_beside_the_star_are_found(documents):
    """The bucket's smallest id links with nothing, two others link with each other."""
    rng = random.Random(6)
    base = " ".join(f"w{k}" for k in range(100))
    far = [varied(rng, base, 0.05) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(far)] + [(100 + k, " ".join(t.split()[:-1])) for k, t in enumerate(far)]
    assert {tuple(r) for r in near_dedup.near_groups(documents(rows)).collect()} == brute(rows)


def test_odd_rows(documents, odd_texts):
    rows = near_dedup.near_groups(documents(odd_texts)).collect()
    assert len(rows) == len(odd_texts)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert by[1] == by[2] == [(0, 1, True)] or by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)]
    assert by[None] == [(1, None, True)]
    assert by[6] == [(1, 6, True)] and by[7] == [(1, 6, False)] * 2


def test_one_of_each_group_stays(documents):
    df = documents([(3, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (9, "other words here"), (None, "x"), (5, "")])
    out = near_dedup.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [2, 5, 9, None]
    assert near_dedup.drop_near_duplicates(df.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    probes = near_dedup._probes(128)
    rates = []
    for n in (3, 30, 3000):
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**63, 2 * n, dtype=np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([a[: n + n // 3], a[:1]]))
            rates.append((near_dedup.signature(a, 128, probes) == near_dedup.signature(b, 128, probes)).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(rates)) < 0.05


@pytest.mark.parametrize("edges", [[(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 50)], [(5, 4), (4, 5), (9, 9)]])
def test_components(spark, edges):
    got = dict(connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    top = {x: x for e in edges for x in e}
    for _ in top:
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    assert got == top


def test_hubs_are_spread_and_names_do_not_clash(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "HUB", 3)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(80)] + [(100 + i, " ".join(f"y{i}z{k}" for k in range(20))) for i in range(5)]
    df = documents(rows)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_groups(df).collect())
    assert got == sorted(brute(rows))
    for name in ("_kept_id", "_kept_rank", "id", "hash", "row", "rank", "_hot", "_salt", "a", "b"):
        df = df.withColumn(name, F.lit(1))
    kept = near_dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 100, 101, 102, 103, 104]
    assert near_dedup.drop_near_duplicates(df.limit(0)).count() == near_dedup.near_groups(df.limit(0)).count() == 0
