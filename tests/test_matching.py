import random
import re

import pytest

from sparkloom.operators import matching as M, merging as G, scale

NAMES = ["Lion", "lion!", "Big  Cat", "big cat", "Puma (x)", "puma", "", None, "(y)", "Café", "caf", "Lynx lynx", "Lynx  Lynx (z)"]


def norm(s):
    if s is None:
        return None
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", s, flags=re.A)).lower().strip() or None


def base(s):
    return None if s is None else s.split("(")[0].strip() if "(" in s else s


def best(left, rights):
    cn, sci = norm(left["common_name"]), norm(left["scientific_name"])
    alts = {norm(a) for a in left["common_name_alternative"] or []} - {None}
    found = []
    for r in rights:
        an, bn = norm(r["animal_name"]), norm(base(r["animal_name"]))
        walts = [(norm(a), a) for a in r["animal_name_alternative"] or [] if norm(a)]
        scis = [(norm(a), a) for a in r["scientific_names"] or [] if norm(a)]
        gs_raw = " ".join(x for x in (r["genus"], r["species"]) if x is not None)
        first = lambda pairs, ok: next((raw for n, raw in pairs if ok(n)), None)
        same = lambda a, b: a is not None and a == b
        rules = [
            (1, same(cn, an), r["animal_name"]),
            (2, any(same(cn, n) for n, _ in walts), first(walts, lambda n: n == cn)),
            (3, same(cn, bn), r["animal_name"]),
            (4, an in alts, r["animal_name"]),
            (5, any(n in alts for n, _ in walts), first(walts, lambda n: n in alts)),
            (6, bn in alts, base(r["animal_name"])),
            (7, any(same(sci, n) for n, _ in scis), first(scis, lambda n: n == sci)),
            (8, same(sci, norm(r["taxon"])), r["taxon"]),
            (9, same(sci, norm(gs_raw)), gs_raw),
            (10, same(sci, an), r["animal_name"]),
            (11, same(sci, bn), base(r["animal_name"])),
        ]
        for code, ok, name in rules:
            if ok:
                found.append((code, r["wiki_id"] is not None, r["wiki_id"] or 0, r["wiki_key"], name))
                break
    return min(found, default=None)


def sides(seed, n_left, n_right, hot=0.0):
    random.seed(seed)
    pick = lambda: "Lion" if random.random() < hot else random.choice(NAMES)
    names = lambda: None if random.random() < 0.2 else [pick() for _ in range(random.randint(0, 3))]
    left = [dict(key=f"k{i}", common_name=pick(), common_name_alternative=names(), scientific_name=pick()) for i in range(n_left)]
    right = [
        dict(wiki_key=f"w{i}", animal_name=pick(), animal_name_alternative=names(), scientific_names=names(),
             wiki_id=None if random.random() < 0.1 else random.randint(0, 40), taxon=pick(), genus=pick(), species=pick())
        for i in range(n_right)
    ]
    return left, right


def frames(spark, left, right):
    return spark.createDataFrame(left, M.LEFT_SCHEMA), spark.createDataFrame(right, M.RIGHT_SCHEMA)


@pytest.mark.parametrize("seed,n_left,n_right,hot,hot_rows", [(1, 300, 3, 0, 200_000), (2, 300, 60, 0.0, 10), (3, 900, 300, 0.33, 10)])
def test_matches_equal_testing_every_pair(spark, monkeypatch, seed, n_left, n_right, hot, hot_rows):
    monkeypatch.setattr(scale, "HOT_ROWS", hot_rows)
    left, right = sides(seed, n_left, n_right, hot)
    got = {r.key: r for r in M.match_entities(*frames(spark, left, right)).collect()}
    assert len(got) == n_left
    seen = set()
    for rec in left:
        want, r = best(rec, right), got[rec["key"]]
        if want is None:
            assert r.match_type is None and r.wiki_key is None
        else:
            seen.add(want[0])
            assert (r.match_type, r.wiki_key, r.matched_name) == (want[0], want[3], want[4])
    assert seen


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_matching_joins_by_key_only(spark):
    left, right = frames(spark, *sides(1, 5, 5))
    text = plan(M.match_entities(left, right))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_merge_by_type(spark):
    left = spark.createDataFrame([("a", "x", ["p", "q"], 1, None, "k"), ("b", None, None, 2, "s", None)], "key string, s string, l array<string>, n int, only_l string, mixed string")
    right = spark.createDataFrame([("w", "y", ["q", "r"], 1, 9, ["z"])], "wiki_key string, s string, l array<string>, n int, only_r int, mixed array<string>")
    matches = spark.createDataFrame([("a", "w", "m", 1, 7), ("b", None, None, None, None)], "key string, wiki_key string, matched_name string, match_type int, wiki_id bigint")
    a, b = sorted(G.merge_records(left, right, matches).collect(), key=lambda r: r.key)
    assert (a.s, a.l, a.n, a.only_r, a.mixed, a.wiki_id) == (["x", "y"], ["p", "q", "r"], [1], 9, ["k"], 7)
    assert (b.s, b.l, b.n, b.only_l, b.wiki_key, b.match_type) == (None, None, [2], "s", None, None)


def test_finished_records(spark):
    merged = spark.createDataFrame(
        [("a", "Sci name", ["Other one"], ["A", " "], [" B ", "A"], "''x'' &eacute;\n y", [" H1 ", ""], "m0", 5, "t", "g", "sp")],
        "key string, scientific_name string, scientific_names array<string>, common_name_alternative array<string>, animal_name_alternative array<string>,"
        " abstract string, text_sections array<string>, meta string, wiki_id bigint, taxon string, genus string, species string",
    )
    r = G.finish_merged(merged).first()
    assert r.scientific_names == ["Other one", "Sci name"] and r.common_name_alternative == ["A", "B"]
    assert r.abstract == "x é y H1" and r.meta.original_meta == "m0" and r.meta.wiki_id == 5
    assert set(r.asDict()) == {"key", "scientific_names", "common_name_alternative", "abstract", "meta", "species"}
