import hashlib
import random

import pytest

from sparkloom.llm import substrings


def brute(rows, window):
    first = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out[i] = (len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def found(df, window):
    return {r["doc_id"]: (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept_sha256"]) for r in substrings.repeated_spans(df, window=window).collect()}


@pytest.mark.parametrize("window", [50, 7, 2])
def test_spans_equal_brute_force(documents, window):
    rng = random.Random(window)
    passages = [[f"p{rng.randint(0, 400)}" for _ in range(rng.randint(20, 120))] for _ in range(12)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice([rng.choice(passages), [f"u{rng.randint(0, 10**9)}" for _ in range(60)], rng.choice(passages)[5:], ["x"] * 70])
        rows.append((i - 20, " ".join(words)))
    rows += [(500, rows[30][1]), (501, rows[30][1].replace(" ", "\n")), (502, None), (503, "")]
    rng.shuffle(rows)
    assert found(documents(rows), window) == brute(rows, window)


def test_passages_of_many_texts_are_spread(documents, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 3)
    passage = [f"p{k}" for k in range(60)]
    rows = [(i, " ".join([f"a{i}", *passage, f"b{i}"])) for i in range(200)] + [(i, f"alone {i} " * 40) for i in range(300, 310)]
    assert found(documents(rows), 50) == brute(rows, 50)


def test_odd_rows(documents, odd_texts):
    rows = substrings.repeated_spans(documents(odd_texts)).collect()
    assert len(rows) == len(odd_texts)
    assert all(r["n_words"] == 0 and r["spans"] == [] for r in rows if r["doc_id"] in (1, 2, 3))
    assert substrings.repeated_spans(documents([(1, "a")]).limit(0)).count() == 0


def test_rows_without_an_id_and_repeated_ids(documents):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, text), (2, text), (2, text), (3, "start " + text)]
    got = sorted(((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in substrings.repeated_spans(documents(rows)).collect()), key=repr)
    assert got == [(2, []), (2, []), (3, [(1, 61)]), (None, [])]


def test_text_without_repeats(documents):
    text = " ".join(f"w{k}" for k in range(60))
    got = dict(substrings.without_repeats(documents([(1, text), (2, "a " + text + " b"), (3, None)])).collect())
    assert got == {1: text, 2: "a b", 3: ""}


def test_window_anchors_are_minima():
    import numpy as np

    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 300, dtype=np.uint64)
    for window in (2, 7, 50):
        low = substrings.rolling(hashes, window // 2, substrings._BASES[0])
        span = window - window // 2 + 1
        assert (substrings.window_anchors(hashes, window) == [low[k : k + span].min() for k in range(len(low) - span + 1)]).all()
