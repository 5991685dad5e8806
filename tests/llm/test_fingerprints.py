import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.llm import fingerprints as fp
from sparkloom.llm import queries


def shingles(text, width=5):
    words = (text or "").encode().split()
    if not words:
        return set()
    return {hashlib.md5(b" ".join(words[i : i + width])).hexdigest()[:12] for i in range(max(1, len(words) - width + 1))}


def sketch(text, size=128):
    return sorted(shingles(text))[:size]


def likeness(a, b, size=128):
    if not a and not b:
        return 1.0
    union = sorted({*a, *b})[:size]
    return len({*union} & {*a} & {*b}) / len(union)


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))


def test_query_equals_brute_force(spark, tmp_path, documents, odd_texts):
    rng = random.Random(1)
    rows = [(i, words(rng, rng.choice([0, 1, 3, 5, 6, 40, 400]))) for i in rng.sample(range(-50, 10_000), 80)]
    rows += [(i + 20_000, t) for i, t in odd_texts if i not in (None, 7)] + [(40_000, rows[3][1])]
    rng.shuffle(rows)
    documents(rows).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op13_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(order, [*order[1:], order[0]]):
        text, after, r = text or "", after or "", got.pop(i)
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == ("".join(sketch(text)), "".join(sketch(edited)))
        assert r["near_edited"] == likeness(sketch(text), sketch(edited)) and r["near_next"] == likeness(sketch(text), sketch(after))
    assert not got


def test_estimates_are_close(spark):
    rng = random.Random(2)
    a = [f"a{rng.random()}" for _ in range(6000)]
    b = a[:4000] + [f"b{rng.random()}" for _ in range(1000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string").select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    r = df.select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("b"), F.col("a")), fp.containment(F.col("a"), F.col("b")), fp.distinct_count(F.col("a"))).first()
    both = len(shingles(" ".join(a)) & shingles(" ".join(b)))
    n_a, n_b = 5996, 4996
    assert abs(r[0] - both / (n_a + n_b - both)) < 0.13 and abs(r[1] - both / n_b) < 0.25 and abs(r[2] - both / n_a) < 0.25
    assert abs(r[3] - n_a) < 0.3 * n_a


def test_small_sets_are_exact(spark):
    df = spark.createDataFrame([("a b c d e f g", "b c d e f g h"), ("", ""), ("", "x"), ("one two", "one two")], "a string, b string")
    s = df.select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    rows = s.select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("a"), F.col("b")), fp.distinct_count(F.col("a"))).collect()
    assert [tuple(r) for r in rows] == [(0.5, pytest.approx(2 / 3), 3.0), (1.0, 1.0, 0.0), (0.0, 1.0, 0.0), (1.0, 1.0, 1.0)]


def test_merging_equals_the_sketch_of_the_union(spark):
    rng = random.Random(3)
    parts = [(k % 3, words(rng, 300)) for k in range(60)] + [(7, ""), (7, None), (None, words(rng, 9)), (None, words(rng, 9))]
    df = spark.createDataFrame(parts, "source int, text string").withColumn("doc_id", F.lit(1))
    sketches = df.select("source", fp.sketch(F.col("text")).alias("sketch"))
    got = {r["source"]: r["sketch"] for r in fp.merged(sketches, ["source"]).collect()}
    for source in (0, 1, 2, 7, None):
        assert got[source] == sorted(set().union(*[shingles(t) for s, t in parts if s == source]))[:128]
    two = sketches.filter("source = 0").limit(2).collect()
    pair = spark.createDataFrame([(two[0]["sketch"], two[1]["sketch"])], "a array<string>, b array<string>")
    assert pair.select(fp.merge(F.col("a"), F.col("b"))).first()[0] == sorted({*two[0]["sketch"], *two[1]["sketch"]})[:128]


def test_odd_rows(documents, odd_texts):
    rows = fp.fingerprints(documents(odd_texts)).collect()
    assert len(rows) == len(odd_texts)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_chars"] == 0 and by_id[1]["sketch"] == [] and by_id[3]["sketch"] == [] and len(by_id[4]["sketch"]) == 1
    # Null ids come last, rows with one id and text are one document.
    pairs = fp.edited_by_next(documents(odd_texts)).collect()
    assert len(pairs) == len(odd_texts)
    by_id = {r["doc_id"]: r for r in pairs}
    assert by_id[7]["edited"] == "same text here"[:7] + "same text here"[:7] and by_id[1]["edited"] == ""
    assert by_id[None]["edited"] == "no " + odd_texts[-1][1][:2]  # the last one goes on with the first
    assert fp.edited_by_next(documents([(1, "a")]).limit(0)).count() == 0
    assert [r["edited"] for r in fp.edited_by_next(documents([(1, "abc")])).collect()] == ["aba"]


def test_plan_is_native(documents):
    for df in (fp.fingerprints(documents([(1, "a")])), fp.edited_by_next(documents([(1, "a")]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
