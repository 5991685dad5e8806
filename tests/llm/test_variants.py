import random
import re
import zlib
from collections import Counter

import pytest

from sparkloom.llm import queries, variants


def near(a, b):
    """One insertion, deletion or replacement apart, by trying all of them."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts, ratio=10):
    rows = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        rows[w] = (form, n, len(others), counts[form] if form else None)
    out = {}
    for w, (form, n, near_words, form_n) in rows.items():
        root = w
        while rows[root][0]:
            root = rows[root][0]
        out[w] = (form, root, n, near_words, form_n)
    return out


def vocabulary(seed, letters="abé", size=500, longest=12):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(7, longest))) for _ in range(size // 4)}
    for w in list(words) * 3:
        k, c = rng.randrange(len(w)), rng.choice(letters)
        words.add(rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :], w[:k] + c + w[k:]]))
    return {w: int(2 * 10 ** rng.uniform(0, 4)) for w in words if len(w) >= 7}


def found(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    rows = variants.spelling_variants(df, **options).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("most", [4096, 5, 1])
def test_variants_equal_brute_force(spark, most):
    counts = vocabulary(most)
    assert found(spark, counts, most=most) == brute(counts)


def test_one_group_holds_every_pair_once(spark):
    counts = vocabulary(3, "ab", 200, 9)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    for most in (4096, 2):
        groups = {}
        for r in variants.grouped(df, most).collect():
            groups.setdefault((r["key"], r["size"], r["low"], r["high"]), []).append(r["word"])
        met = Counter()
        for (_, size, low, high), members in groups.items():
            index = variants.LetterIndex(members, size, low, high)
            for w in members:
                bits = index.near_long(w) if len(w) == size else index.near_short(w)
                met.update((w, x) for k, x in enumerate(members) if bits >> k & 1)
        assert met == Counter((a, b) for a in counts for b in counts if a != b and near(a, b))


def test_hot_groups_are_split_to_a_bound(spark):
    # All words share their first half; only finer pieces tell them apart.
    rng = random.Random(4)
    counts = {"prefixes" + "".join(rng.choices("abcdefgh", k=8)): 5 for _ in range(3000)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    sizes = variants.grouped(df, 50).groupBy("key", "size", "low", "high").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 50


def test_chains_and_ties(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "zzzzzzz": 2, "zzzzzzx": 30, "zzzzzzy": 30, "lonelyword": 9}
    rows = found(spark, counts)
    assert rows == brute(counts)
    assert rows["aaaaaaa"][:2] == ("aaaaaab", "aaaabbb") and rows["zzzzzzz"][0] == "zzzzzzx"


def test_letter_runs_and_lost_letters(spark, documents, odd_texts):
    rows = [(3, "Élan ÉLAN élan naïve-test L'été x_y ×÷ Ābc ʼn"), (4, "spelling Spelling SPELLING"), (None, "spelling"), *odd_texts]
    counts = Counter()
    altered = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda c: c[0].lower(), run)
            counts[run] += 1
            h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
            altered[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    assert dict(variants.letter_runs(documents(rows)).collect()) == dict(counts)
    assert dict(variants.letter_runs(documents(rows), alter=queries.one_letter_lost).collect()) == dict(altered)


def test_odd_words(spark):
    long = "q" * 60_000
    rows = [(None, 5), ("short", 90), ("repeated", 1), ("repeated", 1), ("once-only", 1), (long, 2), (long[1:], 50), ("", 4)]
    got = {r["word"]: (r["form"], r["n"], r["n_near"]) for r in variants.spelling_variants(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert got == {"repeated": (None, 2, 0), long: (long[1:], 2, 1), long[1:]: (None, 50, 1)}
    assert variants.spelling_variants(spark.createDataFrame([], "word string, n bigint")).count() == 0
