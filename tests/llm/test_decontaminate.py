import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate as d


@pytest.fixture(scope="module")
def benchmark(spark):
    rng = random.Random(1)
    items = [(k, " ".join(f"b{rng.randint(0, 2000)}" for _ in range(n))) for k, n in enumerate([15, 20, 30, 60, 40])]
    return items + [(50, "two words"), (51, ""), (52, None), (53, "Solo!")]


def frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as words", "2 as seed", "3 as doc_id")


@pytest.mark.parametrize("bound", [10**6, 0])
def test_planted_passages(spark, documents, benchmark, bound):
    rng = random.Random(2)
    filler = [f"f{k}" for k in range(5000)]
    items = dict(benchmark)

    def hidden(words):
        return " ".join(rng.sample(filler, 40) + words + rng.sample(filler, 40))

    swapped = items[3].split()
    for k in range(0, 60, 8):
        swapped[k] = "other"
    rows = [
        (1, hidden(items[0].split())), (2, hidden(items[1].upper().split())), (3, hidden([w + "." for w in items[2].split()])), (4, hidden(swapped)), (5, hidden([])),
        (6, hidden(items[3].split()[20:45])), (7, hidden(items[4].split()[:8])), (8, items[0]), (9, "x two WORDS y"), (10, "words two"), (11, None), (12, ""), (13, "solo"), (None, items[0]),
        (14, hidden(items[0].split() + ["gap"] + items[0].split())), (14, items[1]), (15, " ".join(items[4].split()[10:])),
    ]
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["matched"], r["n_tokens"]) for r in d.contaminated(documents(rows), frame(spark, benchmark), broadcast_seeds=bound).collect()}
    assert got == {
        (1, 0): (40, 15, 15), (2, 1): (40, 20, 20), (3, 2): (40, 30, 30), (4, 3): (40, 52, 60), (6, 3): (20, 25, 60), (8, 0): (0, 15, 15), (9, 50): (1, 2, 2), (13, 53): (0, 1, 1),
        (14, 0): (40, 15, 15), (14, 1): (0, 20, 20), (15, 4): (-10, 30, 40),
    }


def test_filter(spark, documents, benchmark):
    df = documents([(1, dict(benchmark)[2]), (2, "clean text"), (3, None), (None, dict(benchmark)[2])])
    out = d.without_contaminated(df, frame(spark, benchmark))
    assert out.columns == df.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [2, 3, None]


def test_empty_tables(spark, documents, benchmark):
    df = documents([(1, "some text that is clean")])
    assert d.contaminated(df.limit(0), frame(spark, benchmark)).count() == 0
    assert d.contaminated(df, frame(spark, benchmark).limit(0)).count() == 0
    assert d.without_contaminated(df, frame(spark, benchmark).limit(0)).count() == 1


def test_no_python_in_the_plan(spark, documents, benchmark, capsys):
    d.contaminated(documents([(1, "a")]), frame(spark, benchmark)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("bound", [10**6, 0])
def test_every_placement_of_substitutions(spark, documents, bound):
    rng = random.Random(5)
    lengths = [1, 2, 3, *range(4, 26), 28, 30]
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in lengths}
    rows, want = [], {}
    for n, words in items.items():
        allowed = n - math.ceil(0.8 * n - 1e-9)
        for m in (allowed, allowed + 1):
            places = [*itertools.combinations(range(n), m)]
            for gone in places if len(places) <= 40 else rng.sample(places, 40):
                laid = ["other" if k in gone else w for k, w in enumerate(words)]
                rows.append((len(rows), " ".join(["before", "it", *laid, "after"])))
                part = any(sum(k not in gone for k in range(a, a + 20)) >= 17 for a in range(n - 19)) and n > 20
                if m == allowed or part:
                    want[(len(rows) - 1, n)] = (2, n - m, n)
    got = d.contaminated(documents(rows), frame(spark, [(n, " ".join(words)) for n, words in items.items()]), broadcast_seeds=bound).collect()
    assert {(r["doc_id"], r["item_id"]): (r["start"], r["matched"], r["n_tokens"]) for r in got} == want


def test_clashing_names_of_the_filter(spark, documents):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id bigint, text string")
    df = documents([(1, "x one two three four five six seven eight y"), (2, "clean words"), (None, "no id")])
    for name in ("_held", "row", "ids"):
        df = df.withColumn(name, F.lit(1))
    kept = d.without_contaminated(df, bench)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {2, None}
    assert d.without_contaminated(df.limit(0), bench).count() == 0
    assert d.without_contaminated(df, bench.limit(0)).count() == 3


def whole(n, gone, masks):
    """Whether some placement of a mask in ``n`` tokens looks at none of the tokens that differ."""
    return any(
        all(c == "0" or start + k not in gone for k, c in enumerate(m)) for m in masks for start in range(n - len(m) + 1)
    )


def test_masks_lose_nothing_and_are_all_needed():
    rng = random.Random(7)
    for n in range(1, 61):
        masks, allowed = d.masks_of(n), d.differing(n)
        assert masks == d.masks_of(min(n, d._LONG)) and (n < 5 or all("0" in m for m in masks))
        places = itertools.combinations(range(n), allowed) if math.comb(n, allowed) <= 20_000 else (rng.sample(range(n), allowed) for _ in range(20_000))
        assert all(whole(n, set(gone), masks) for gone in places), n
        for m in masks if n in (20, 21, 22) else ():
            rest = tuple(x for x in masks if x != m)
            assert not all(whole(n, set(gone), rest) for gone in itertools.combinations(range(n), allowed))
    for gone in itertools.combinations(range(20), 3):  # parts of long items
        assert whole(20, set(gone), d.masks_of(61))


def test_the_masks_find_the_overlaps(spark, documents):
    words = [f"t{k}" for k in range(30)]
    bench = frame(spark, [(1, " ".join(words))])
    rows = documents([(1, " ".join(words)), (2, " ".join("x" if k % 5 == 4 else w for k, w in enumerate(words)))])
    assert {r["doc_id"] for r in d.contaminated(rows, bench).collect()} == {1, 2}
    # A mask that is longer than the item finds nothing; neighbouring tokens miss the second text, of which no five in a row are equal.
    assert d.contaminated(rows, bench, masks=lambda n: ("1" * 400,)).count() == 0
    assert {r["doc_id"] for r in d.contaminated(rows, bench, masks=lambda n: ("11111",)).collect()} == {1}
