import math
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import field_search as B, index as I, leaves as L, scale, search as S

WORDS = [f"w{i}" for i in range(100)]


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(1)
    # One word is in a third of all positions.
    docs = [(i, " ".join(random.choice(WORDS) if random.random() > 0.33 else "hot" for _ in range(random.randint(0, 40)))) for i in range(300)]
    return docs, spark.createDataFrame(docs, "doc_id bigint, text string")


def random_expr(depth):
    if depth == 0 or random.random() < 0.2:
        w = random.choice(WORDS + ["hot", "missing"])
        return S.term(w), w
    (a, x), (b, y) = random_expr(depth - 1), random_expr(depth - 1)
    return (a & b, ("and", x, y)) if random.random() < 0.5 else (a | b, ("or", x, y))


def holds(tree, words):
    if isinstance(tree, str):
        return tree in words
    op, x, y = tree
    return (holds(x, words) and holds(y, words)) if op == "and" else (holds(x, words) or holds(y, words))


def terms_of(tree):
    return {tree} if isinstance(tree, str) else terms_of(tree[1]) | terms_of(tree[2])


def brute(docs, tree):
    n = len(docs)
    bags = {d: t.split() for d, t in docs}
    df = {w: sum(w in b for b in bags.values()) for w in terms_of(tree)}
    out = {}
    for d, bag in bags.items():
        if holds(tree, set(bag)):
            out[d] = sum(bag.count(w) * math.log10(n / df[w]) for w in terms_of(tree) if df[w])
    return out


def test_search_equals_set_algebra(spark, corpus):
    docs, df = corpus
    random.seed(2)
    cases = {f"q{i}": random_expr(3) for i in range(40)}
    wide = [S.term(w) for w in WORDS]
    cases["wide_any"] = (S.any_of(*wide), WORDS[0])
    cases["wide_mixed"] = (S.any_of(*wide) & S.term("hot"), None)
    for w in WORDS[1:]:
        cases["wide_any"] = (cases["wide_any"][0], ("or", cases["wide_any"][1], w))
    cases["wide_mixed"] = (cases["wide_mixed"][0], ("and", cases["wide_any"][1], "hot"))
    cases["wide_all"] = (S.all_of(*[S.term(w) for w in ["hot"] + WORDS[:3]]), ("and", ("and", ("and", "hot", "w0"), "w1"), "w2"))
    queries = S.query_table(spark, {k: e for k, (e, _) in cases.items()})
    found = S.match_scores(I.build_index(I.text_tokens(df), I.collection_size(df)), queries).collect()
    got = {k: {} for k in cases}
    for r in found:
        got[r.query_id][r.doc_id] = r.tfidf
    for k, (_, tree) in cases.items():
        want = brute(docs, tree)
        assert got[k].keys() == want.keys(), k
        assert all(abs(got[k][d] - want[d]) < 1e-9 for d in want), k


def test_many_terms_take_the_shuffle_path(spark, corpus, monkeypatch):
    _, df = corpus
    queries = S.query_table(spark, {"a": S.term("hot") & S.term("w1"), "b": S.term("w2") | S.term("w3")})
    index = I.build_index(I.text_tokens(df), I.collection_size(df))
    rows = lambda d: sorted(map(tuple, d.withColumn("tfidf", F.round("tfidf", 9)).select("query_id", "doc_id", "tfidf").collect()))
    want = rows(S.match_scores(index, queries))
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(scale, "HOT_ROWS", 5)
    assert rows(S.match_scores(index, queries)) == want and want


def test_field_scores_on_the_shuffle_path(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"bear {i % 3}", " ".join(["bear"] * (i % 5) + ["x"] * i)) for i in range(40)], "doc_id bigint, name string, body string")
    rows = B.field_documents(B.search_documents(docs, F.col("name"), L.typed_leaves(docs, ["body"])))
    queries = spark.createDataFrame([("q", "bear x"), ("r", "2")], "query_id string, text string")
    wanted = B.field_query_terms(queries)

    def scores():
        index = B.field_index(rows, wanted.select("field", "term").distinct())
        return sorted((r.query_id, r.doc_id, round(r.score, 6)) for r in B.field_scores(index, wanted).collect())

    want = scores()
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(scale, "HOT_ROWS", 5)
    assert scores() == want and len(want) > 40


def test_every_hot_value_is_salted(spark):
    from pyspark.sql import Window

    left = spark.range(0, 60_000).select((F.col("id") % 2100).alias("v"), F.col("id").alias("i"))
    left = left.unionByName(spark.range(10).select(F.lit(None).cast("bigint").alias("v"), F.col("id").alias("i")))
    hot = scale.hot_values(left.filter("v < 2000 or v is null"), ["v"], hot_rows=8)
    assert hot.count() == 2001 and hot.agg(F.min("_salts")).first()[0] >= 2
    right = spark.range(0, 2050).select(F.col("id").alias("v"), (F.col("id") * 2).alias("w"))
    for how in ("left", "inner", "left_anti", "left_semi"):
        got = scale.lookup_join(left, right, ["v"], ["i"], how, hot_rows=8)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, left.join(right, "v", how).collect()), key=repr)


def test_hot_values_are_a_share_of_the_rows(spark):
    rows = spark.range(0, 100_000).select(F.when(F.col("id") < 60_000, 1).otherwise(F.col("id")).alias("v"), "id")
    hot = scale.hot_values(rows, ["v"]).collect()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(scale.HOT_ROWS, 100_000 // partitions)
    assert [r._salts for r in hot] == [-(-60_000 // share)]


def test_salted_joins_store_hot_values_only(spark, monkeypatch):
    stored, cut = [], scale.cut_lineage
    monkeypatch.setattr(scale, "cut_lineage", lambda df: stored.append(df.columns) or cut(df))
    left = spark.range(0, 1000).select(F.lit(1).alias("v"), "id")
    right = spark.createDataFrame([(1, 2)], "v int, w int")
    plain = scale.lookup_join(left, right, ["v"], ["id"], "left")
    spread = scale.lookup_join(left, right, ["v"], ["id"], "left", hot_rows=100)
    assert stored == [["_hot", "_salts"]] * 2 and plain.count() == spread.count() == 1000
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan(plain) and "_salt" in plan(spread)
    assert scale.lookup_join(left.limit(0), right, ["v"], ["id"], "inner").count() == 0


def test_levels_are_those_of_the_brackets(spark):
    texts = {"1": 1, "[]": 1, '{"a": [1, {"b": "[[[["}], "c\\"[": {}}': 3, "[" + ",".join(['{"a": 1}'] * 1000) + "]": 2, "[" * 40 + "]" * 40: 40, None: 1}
    df = spark.createDataFrame([(t, n) for t, n in texts.items()], "t string, n int")
    assert [(r.n, r.got) for r in df.select("n", L._levels(F.col("t")).alias("got")).collect() if r.n != r.got] == []


def test_adjacent_and_malformed_queries(spark, corpus):
    docs, df = corpus
    exprs = {
        "adjacent": S.term("w1").then(S.term("w2")),
        "lost": S.term("hot") & S.term("-"),
        "empty": S.term("?"),
        "first": S.term("hot_w1"),
        "colon": S.term("w5:"),
        "extra": S.term("w1").then(S.term("w2") & S.term("w3")),
    }
    index = I.build_index(I.text_tokens(df), I.collection_size(df))
    got = {}
    for r in S.boolean_search(index, S.query_table(spark, exprs)).collect():
        got.setdefault(r.query_id, set()).add(r.doc_id)
    having = lambda w: {d for d, t in docs if w in t.split()}
    assert got == {"adjacent": having("w1"), "first": having("hot"), "colon": having("w5"), "extra": having("w1")}


def test_ranks_beyond_the_window_limit(spark):
    rows = spark.range(5000).select(F.lit("q").alias("q"), F.col("id"), (F.col("id") % 77).alias("score"))
    got = scale.top_k(rows, ["q"], [F.desc("score"), F.asc("id")], 1500, ["id"]).collect()
    want = sorted(range(5000), key=lambda i: (-(i % 77), i))[:1500]
    assert [r.id for r in sorted(got, key=lambda r: r.rank)] == want


def test_leaves_of_typed_and_untyped_records(spark):
    text = '{"a": {"b": [1, {"c": "x"}, null, []], "ID": 5}, "z": true, "e": "", "n": {"deep": {"er": [[["v"]]]}}}'
    df = spark.createDataFrame([(1, text)], "doc_id int, j string")
    got = [(r.path, r.key, r.value) for r in L.json_leaves(df, "doc_id", "j").collect()]
    assert got == [("a.ID", "ID", "5"), ("a.b", "b", "1"), ("a.b.c", "c", "x"), ("e", "e", ""), ("n.deep.er", "er", "v"), ("z", "z", "true")]
    typed = spark.sql(
        "select 1 as doc_id, named_struct('b', array(1, 2, null), 'id', 5) as a, map('k', 'v', 'uuid', 'u') as m, cast(null as string) as n, parse_json('{\"p\":[7]}') as j"
    )
    got = [(r.path, r.key, r.value) for r in L.record_leaves(typed, "doc_id").collect()]
    assert got == [("a.b", "b", "1"), ("a.b", "b", "2"), ("a.id", "id", "5"), ("m.k", "k", "v"), ("m.uuid", "uuid", "u"), ("j.p", "p", "7")]
    leaves = L.typed_leaves(typed, ["a", "m", "j"])
    assert typed.select(L.content(leaves, F.lit("name")).alias("c")).first().c == "1\n2\nv\n7"
    deep = "".join('{"k%d": [' % i for i in range(60)) + r'"va\"l[ue"' + "]}" * 60
    df = spark.createDataFrame([(1, deep), (2, "7"), (3, None), (4, "[]")], "doc_id int, j string")
    got = [(r.doc_id, r.key, r.value) for r in L.json_leaves(df, "doc_id", "j").collect()]
    assert got == [(1, "k59", 'va"l[ue'), (2, "", "7")]
    assert df.select(F.size(L.variant_leaves(F.parse_json("j"))).alias("n")).first().n == 1


def test_field_scores_by_hand(spark):
    docs = spark.createDataFrame([(i, "polar bear" if i == 0 else f"bear {i}", " ".join(["bear"] * (i % 5) + ["x"] * i * 3)) for i in range(60)], "doc_id bigint, name string, body string")
    rows = B.field_documents(B.search_documents(docs, F.col("name"), L.typed_leaves(docs, ["body"])))
    queries = spark.createDataFrame([("q", "polar bear")], "query_id string, text string")
    got = {r.doc_id: r.score for r in B.search_fields(B.field_index(rows), queries, k=100).collect()}

    def kept(n):
        if n < 40:
            return n
        shift = (n - 24).bit_length() - 4
        return 24 + ((n - 24) >> shift << shift)

    fields = {d.doc_id: {"name": d.name.split(), "content": (d.body or d.name).split(), "exact_name": [d.name]} for d in docs.collect()}
    want = {}
    for field, terms in (("name", ["polar", "bear"]), ("content", ["polar", "bear"]), ("exact_name", ["polar bear"])):
        n, total = len(fields), sum(len(f[field]) for f in fields.values())
        for t in terms:
            df = sum(t in f[field] for f in fields.values())
            for d, f in fields.items():
                tf = f[field].count(t)
                if tf:
                    norm = 1.2 * (0.25 + 0.75 * kept(len(f[field])) / (total / n))
                    want[d] = want.get(d, 0) + math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + norm)
    assert got.keys() == want.keys()
    assert all(abs(got[d] - want[d]) < 1e-5 for d in want)
    assert max(got, key=got.get) == 0


def test_mixed_queries_start_from_necessary_terms(spark, corpus):
    docs, df = corpus
    index = I.build_index(I.text_tokens(df), I.collection_size(df))
    hot, w1, w2, w3 = S.term("hot"), S.term("w1"), S.term("w2"), S.term("w3")
    queries = S.prepare(S.query_table(spark, {
        "a": hot & w1, "b": w2 | w3, "c": hot & S.term("nowhere"), "d": hot, "e": hot & (w1 | w2), "f": (hot | w1) & w3, "g": (hot & w1) | (hot & w2), "h": w3.then(hot), "i": hot & (w1 | S.term("nowhere")),
    }))
    weighted = index.terms.join(queries.terms, ["field", "term"])
    cover = {}
    for r in S.necessary_terms(weighted, queries).collect():
        cover.setdefault(r.query_id, set()).add(r.term)
    assert cover == {"a": {"w1"}, "c": {"nowhere"}, "e": {"w1", "w2"}, "f": {"w3"}, "g": {"w1", "w2"}, "h": {"w3"}, "i": {"w1", "nowhere"}}
    hits = S._hits(S._wanted(index, queries), weighted, queries)
    got = {q: {r.doc_id for r in hits.filter(F.col("query_id") == q).select("doc_id").distinct().collect()} for q in "abcdefghi"}
    having = lambda *w: {d for d, t in docs if set(w) & set(t.split())}
    want = {"a": having("w1"), "b": having("w2", "w3"), "c": set(), "d": having("hot"), "e": having("w1", "w2"), "f": having("w3"), "g": having("w1", "w2"), "h": having("w3"), "i": having("w1")}
    assert got == want
    assert {r.query_id for r in S.match_scores(index, queries).select("query_id").distinct().collect()} == set("abdefghi")


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_bounds_do_not_change_the_best(spark, corpus, k):
    _, df = corpus
    index = I.build_index(I.text_tokens(df), I.collection_size(df))
    random.seed(k)
    cases = {f"q{i}": random_expr(3)[0] for i in range(25)}
    cases |= {f"any{i}": S.any_of(*[S.term(w) for w in random.sample(WORDS + ["hot", "missing"], 12)]) for i in range(25)}
    cases["none"] = S.term("missing")
    queries = S.prepare(S.query_table(spark, cases))
    for rank in (S.rank_tfidf, S.rank_tfidf_smooth):
        want, got = (sorted(map(tuple, rank(index, queries, k, direct).collect())) for direct in (10**9, 0))
        assert got == want and len({r[0] for r in got}) > 25


def test_bounds_leave_out_most_documents(spark):
    """On the queries of ``batch_topk`` and ``bm25_content`` at sf0.01, the results being those without bounds."""
    from checks import search_queries as Q
    from checks.index_queries import doc_tokens, documents, read

    sf = "/root/testdata/sf0.01"
    queries, n_docs = S.prepare(Q.item_queries(spark, sf)), I.collection_size(documents(spark, sf))
    index = S.index_for(doc_tokens(spark, sf), n_docs, queries)
    every = S.match_scores(index, queries).count()
    assert S.best_scores(index, queries, "idf_standard", 10, direct=0).count() < 0.5 * every
    rows = B.text_fields(read(spark, sf, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"), "text"), {B.CONTENT: F.col("text")})
    texts = read(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")
    wanted = B.field_query_terms(texts, (B.CONTENT,))
    index = B.field_index(rows, wanted.select("field", "term").distinct())
    every = B.field_scores(index, wanted).count()
    assert B.best_field_scores(index, wanted, 5, direct=0).count() < 0.6 * every
    want, got = (sorted(map(tuple, B.search_fields(index, texts, (B.CONTENT,), 5, direct=direct).collect())) for direct in (10**9, 0))
    assert got == want
