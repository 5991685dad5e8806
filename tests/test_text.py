import html
import random
import re

from sparkloom.fixed_values import HTML_ENTITIES
from sparkloom.functions import text as T

RAW = [
    "Hello, World! a I 7 x9 _under_ 3.14",
    "",
    None,
    "tabs\tand\nlines  éàü Straße naïve",
    "can't stop U.S.A. 1,234.5 a:b 10:30 foo_bar o’clock 'quoted' end.",
    "日本語テキスト and ひらがな",
    "x" * 30000 + " " + "1,2" * 5000,
]


def test_terms_match_plain_python(evaluate):
    def terms(s):
        cleaned = re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", s.lower())).strip()
        return cleaned, [t for t in cleaned.split() if len(t) > 1 or t.isdigit()]

    texts = [t for t in RAW if t is not None]
    assert evaluate(T.clean_terms, texts) == [terms(t)[0] for t in texts]
    assert evaluate(T.tokenize, texts) == [terms(t)[1] for t in texts]
    assert evaluate(T.first_term, texts) == [(terms(t)[1] or [None])[0] for t in texts]
    assert evaluate(T.tokenize, [None]) == [None]


def test_tokenizing_twice_changes_nothing(evaluate):
    once = [" ".join(t) for t in evaluate(T.tokenize, [t for t in RAW if t])]
    assert [" ".join(t) for t in evaluate(T.tokenize, once)] == once


def test_words_follow_the_standard_analyser(evaluate):
    got = evaluate(T.analyze, [RAW[4], RAW[5], "a.b.c.d don''t x- -y"])
    assert got[0] == ["can't", "stop", "u.s.a", "1,234.5", "a:b", "10", "30", "foo_bar", "o’clock", "quoted", "end"]
    assert got[1] == ["日", "本", "語", "テキスト", "and", "ひ", "ら", "が", "な"]
    assert got[2] == ["a.b.c.d", "don", "t", "x", "y"]
    assert len(evaluate(T.analyze, [RAW[6]])[0]) == 2


def test_format_key(evaluate):
    assert evaluate(T.format_key, ["Skin Type", "__A--b__", "é", "Other Name(s)"]) == ["skin_type", "a_b", "", "other_name_s"]


def test_entities_are_decoded_once(evaluate):
    random.seed(3)
    parts = [*HTML_ENTITIES, "&", "amp;", "x ", "&am", "p;", "&#39", "&unknown;", "\n"]
    texts = ["".join(random.choice(parts) for _ in range(12)) for _ in range(300)]
    pattern = re.compile("|".join(map(re.escape, HTML_ENTITIES)))
    want = [pattern.sub(lambda m: HTML_ENTITIES[m.group(0)], t) for t in texts]
    assert evaluate(T.decode_entities, texts) == want


def test_unescape_matches_the_full_table(evaluate):
    texts = ["&eacute;&nbsp;&#x41;&#128;&amp;lt; &notit; &bogus; a&b", "plain", None, "&lt;b&gt;"]
    assert evaluate(T.unescape_html, texts) == [None if t is None else html.unescape(t) for t in texts]


def test_normal_form_is_ascii_unless_unicode(evaluate):
    names = ["  Café-au lait! ", "日本", "A  (b)\tC", None]
    assert evaluate(T.norm_text, names) == ["cafau lait", "", "a b c", None]
    assert evaluate(lambda c: T.norm_text(c, unicode=True), names) == ["caféau lait", "日本", "a b c", None]


def test_base_name_and_codes(evaluate):
    assert evaluate(T.base_name, ["Puma (genus) x", "Puma", "(x)", None]) == ["Puma", "Puma", "", None]
    texts = ["Critically Endangered", "endangered", " lc ", "Extinct in the Wild", "Least Concer", "other", None, "Near Threatened now"]
    assert evaluate(T.conservation_code, texts) == ["CR", "EN", "LC", "EW", "LC", "other", None, "NT"]


def test_snippet(evaluate):
    long = "a\n" * 100
    assert evaluate(T.snippet, ["x\ny", long, None, "b" * 160]) == ["x y", long.replace("\n", " ")[:157] + "...", None, "b" * 160]


def test_every_entity_is_decoded(evaluate):


    from html.entities import html5

    rng = random.Random(1)
    numbers = [0, 1, 8, 9, 10, 11, 12, 13, 14, 31, 32, 65, 127, 128, 129, 130, 141, 159, 160, 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFDEF, 0xFFFE, 0x1FFFE, 0x10FFFF, 0x110000, 10**12, 0x1F600]
    values = ["&" + n for n in html5] + ["&" + n.rstrip(";") + "x" for n in list(html5)[:300]] + [f"&#{n};" for n in numbers] + [f"&#x{n:X}" for n in numbers]
    values += ["&#", "&", "&&amp;", "&amp;amp;", "&notit;", "& amp;", "&#x0000000041;", "x\n&quot;\ty", "", "&" + "a" * 40 + ";"]
    values += ["".join(rng.choice(["&", "amp", ";", "#", "x41", "65", "lt", "not", " ", "é", "copy", "\n", "<"]) for _ in range(rng.randint(1, 9))) for _ in range(500)]
    assert evaluate(T.unescape_html, values) == [html.unescape(v) for v in values]
    assert evaluate(T.unescape_html, [None]) == [None]
