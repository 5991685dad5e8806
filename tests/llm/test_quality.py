import random
import re
from collections import Counter

from sparkloom.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def measured(df):
    rows = quality.quality(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_counts_equal_brute_force(documents, odd_texts):
    rng = random.Random(1)
    rows = odd_texts + [(100 + k, "".join(rng.choice(["a ", "b ", "c\n", "the ", "#", " ", "\t", "é🙂 "]) for _ in range(rng.randint(0, 120)))) for k in range(200)]
    got = measured(documents(rows))
    want = sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert [g[:6] for g in got] == want
    assert all(g[6] == (g[1] < 50 or 100 * g[5] > 50 * g[1]) and not (g[6] and g[7]) for g in got)


def test_windows_that_share_a_prefix_are_compared_by_words(documents, monkeypatch):
    monkeypatch.setattr(quality, "_PLACE_BITS", 58)  # six bits of hash: prefixes collide all the time
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(80))) for k in range(50)]
    assert [g[5] for g in measured(documents(rows))] == [w[5] for w in sorted(((i, *brute(t)) for i, t in rows), key=repr)]


def test_verdicts(documents):
    rng = random.Random(3)
    prose = " ".join(rng.choice(("the", "of", "and")) + " " + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    junk = {2: " ".join(w + "###" for w in prose.split()), 3: prose.upper().replace(" ", "!! "), 4: " | ".join(prose.split()), 5: "buy now " * 80, 6: "short text"}
    kept = {r["doc_id"]: (r["kept"], r["broken"]) for r in quality.quality(documents([(1, prose), *junk.items()])).collect()}
    assert kept[1] == (True, [])
    assert not any(kept[k][0] for k in junk)
    assert "symbols" in kept[2][1] and "exclamations" in kept[3][1] and "words" in kept[6][1]


def test_filter_keeps_columns_and_rows(documents):
    df = documents([(1, "the of and " + " ".join(f"w{k}a" for k in range(60))), (1, "the of and " + " ".join(f"w{k}a" for k in range(60))), (2, None)])
    out = quality.keep_good(df)
    assert out.columns == df.columns and [r["doc_id"] for r in out.collect()] == [1, 1]
    assert quality.keep_good(df.limit(0)).count() == 0


def test_no_shuffle_and_no_python(documents, capsys):
    quality.quality(documents([(1, "a")])).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_long_clean_texts_stay(documents):
    long = " ".join(f"the w{k} of" for k in range(60_000))
    assert [r["kept"] for r in quality.quality(documents([(1, long)])).collect()] == [True]
    assert quality.quality(documents([(1, "a")]).limit(0)).count() == 0
