"""Text columns: entity decoding, normal forms, tokenisers, snippets."""

import re
from html.entities import html5

from pyspark.sql import Column, functions as F

from sparkloom.fixed_values import (
    CONSERVATION_CODES,
    CONSERVATION_PHRASES,
    HTML_ENTITIES,
    SNIPPET_MAX_CHARS,
)
from sparkloom.functions.columns import bind, first_of

# Letters and digits only, at least two of them, or one digit.
_TERM = r"([a-z0-9]{2,}|[0-9])"

# Unicode words: letters, marks, digits and "_"; an apostrophe, colon or dot between
# letters and a comma, semicolon, apostrophe or dot between digits do not break a word;
# each ideograph is a word of its own.
_WORD_CHAR = r"[\p{L}\p{M}\p{N}_&&[^\p{IsHan}\p{IsHiragana}]]"
_WORD = (
    r"([\p{IsHan}\p{IsHiragana}]"
    rf"|{_WORD_CHAR}+(?:(?:(?<=\p{{L}})['’.:·](?=\p{{L}})|(?<=\p{{N}})['’.,;](?=\p{{N}})){_WORD_CHAR}+)*+)"
)


def decode_entities(col: Column) -> Column:
    """Decode the known entities in one pass; the result is not decoded again."""
    known = "|".join(re.escape(e) for e in HTML_ENTITIES)
    table = F.create_map(*[F.lit(x) for pair in HTML_ENTITIES.items() for x in pair])

    def decoded(text: Column) -> Column:
        parts = F.regexp_extract_all(text, F.lit(f"({known}|[^&]+|&)"), F.lit(1))
        parts = F.transform(parts, lambda t: F.when(t.startswith("&"), F.coalesce(F.try_element_at(table, t), t)).otherwise(t))
        return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)

    return bind(col, decoded)


def _entity(closed: bool):
    """Lookup of named entities of HTML 5, names with or without the closing semicolon.

    A lookup in a map reads its keys one by one, so names are grouped by their first letter
    and a lookup reads the letters and one group.
    """
    groups: dict[str, list[str]] = {}
    for name, chars in html5.items():
        if name.endswith(";") == closed:
            groups.setdefault(name[0], []).append(f"{name.rstrip(';')}\x01{chars}")
    table = F.create_map(
        *[x for letter, names in groups.items() for x in (F.lit(letter), F.str_to_map(F.lit("\x02".join(names)), F.lit("\x02"), F.lit("\x01")))]
    )
    return lambda name: F.try_element_at(F.try_element_at(table, F.left(name, F.lit(1))), name)


def _character(number: Column) -> Column:
    """Character of a numeric reference: unusable numbers become U+FFFD, control signs vanish, 128 to 159 are Windows signs."""
    windows = {n: bytes([n]).decode("cp1252", "replace").replace("\ufffd", chr(n)) for n in range(0x80, 0xA0)}
    table = F.str_to_map(F.lit("\x02".join(f"{n}\x01{c}" for n, c in windows.items())), F.lit("\x02"), F.lit("\x01"))
    unusable = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    low = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127)
    gone = low | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(unusable, F.lit("\ufffd")).when(number.between(0x80, 0x9F), F.try_element_at(table, number.cast("string"))).when(gone, "").otherwise(char)


def unescape_html(col: Column) -> Column:
    """Decode every HTML entity in one pass, as browsers do: a name without semicolon counts by its longest known prefix."""
    pattern = r"(?s)(&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[^\t\n\f <&#;]{1,32};?|[^&]+|&)"
    closed, plain = _entity(True), _entity(False)

    def number(ref: Column) -> Column:
        is_hex = ref.rlike("^&#[xX]")
        digits = F.regexp_replace(F.regexp_extract(ref, "^&#[xX]?([0-9a-fA-F]+)", 1), "^0+(?=.)", "")
        value = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        return F.when(F.length(digits) <= 8, value).otherwise(F.lit(1 << 31))

    def named(ref: Column) -> Column:
        name = F.regexp_extract(ref, "(?s)^&([^;]*)", 1)

        def prefixed(name: Column) -> Column:
            ends = F.sequence(F.length(name), F.lit(1), F.lit(-1))
            end = first_of(F.filter(ends, lambda n: (n >= 2) & plain(F.substring(name, F.lit(1), n)).isNotNull()))
            known = F.concat(plain(F.substring(name, F.lit(1), end)), F.substring(ref, end + 2, F.length(ref)))
            return F.when(end.isNotNull(), known).otherwise(ref)

        whole = F.when(ref.endswith(";"), closed(name))
        return F.coalesce(whole, bind(name, prefixed))

    def decoded(text: Column) -> Column:
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        one = lambda t: F.when(t.startswith("&#") & t.rlike("^&#[xX]?[0-9a-fA-F]"), _character(number(t))).when(t.rlike("^&[^#]"), named(t)).otherwise(t)
        return F.when(text.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(text)

    return bind(col, decoded)


def clean_terms(col: Column) -> Column:
    """Lower-case words of ``[a-z0-9]`` separated by single spaces."""
    return F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))


def tokenize(col: Column) -> Column:
    """Index terms of a text: runs of ``[a-z0-9]`` with two or more characters, or one digit."""
    return F.regexp_extract_all(F.lower(col), F.lit(_TERM), F.lit(1))


def first_term(col: Column) -> Column:
    """First index term of a text, NULL when there is none."""
    return F.nullif(F.regexp_extract(F.lower(col), _TERM, 1), F.lit(""))


def analyze(col: Column) -> Column:
    """Lower-cased Unicode words, as the standard full-text analyser makes them."""
    return F.regexp_extract_all(F.lower(col), F.lit(_WORD), F.lit(1))


def format_key(col: Column) -> Column:
    """Field name of a key: ``[a-z0-9]`` runs joined by one underscore."""
    return F.btrim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "_"), F.lit("_"))


def norm_text(col: Column, unicode: bool = False) -> Column:
    """Normal form of a name. ASCII word characters only, unless ``unicode``."""
    flag = "(?U)" if unicode else ""
    bare = F.regexp_replace(col, flag + r"[^\w\s]", "")
    return F.trim(F.lower(F.regexp_replace(bare, flag + r"\s+", " ")))


def norm_array(col: Column, unicode: bool = False) -> Column:
    return F.transform(col, lambda x: norm_text(x, unicode))


def base_name(col: Column) -> Column:
    """Name without its parenthetical tail."""
    return bind(col, lambda c: F.when(c.contains("("), F.trim(F.substring_index(c, "(", 1))).otherwise(c))


def conservation_code(col: Column) -> Column:
    """Two-letter code of a conservation status; texts without a known phrase stay as they are."""

    def coded(b: Column) -> Column:
        code = F.when(F.upper(b["text"]).isin(*CONSERVATION_CODES), F.upper(b["text"]))
        for phrase, value in CONSERVATION_PHRASES:
            code = code.when(b["text"].contains(phrase), F.lit(value))
        return code.otherwise(b["raw"])

    return bind(col, lambda c: bind(F.struct(c.alias("raw"), F.lower(F.trim(c)).alias("text")), coded))


def snippet(col: Column, max_chars: int = SNIPPET_MAX_CHARS) -> Column:
    """One-line start of a text."""
    return bind(
        F.replace(col, F.lit("\n"), F.lit(" ")),
        lambda line: F.when(
            F.length(line) > max_chars, F.concat(F.left(line, F.lit(max_chars - 3)), F.lit("..."))
        ).otherwise(line),
    )
