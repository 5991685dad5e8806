"""Quality rules: one table of thresholds compiled into one projection of built-in functions."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.llm.common import let, split_words

# Bits of a sorted key that hold the place of a window; the rest are bits of its hash.
_PLACE_BITS = 24


@dataclass(frozen=True)
class Rule:
    """A document is kept when ``low <= numerator / denominator <= high``.

    Metrics are those of ``metrics``; the denominator may be left out. A ratio whose
    denominator is 0 counts as 0.
    """

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None


# Common words of the languages in view, as the stop-word rule counts them.
STOP_WORDS = {
    "en": "the be to of and that have with a in is it for was on are as at by from or an this",
    "fr": "le la les de des du un une et est en que qui dans pour sur pas par au aux avec ce",
    "de": "der die das und ist in zu den mit von für auf dem ein eine nicht sich im auch als des bei",
    "es": "el la los las de que y en un una por con para su se del al es lo no como más",
}

RULES = (
    Rule("words", "n_words", None, 50, None),
    Rule("word_length", "word_chars", "n_words", 2, 12),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations", "n_exclamations", "n_words", None, 0.2),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.3),
    Rule("bullets", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipses", "n_ellipsis_lines", "n_lines", None, 0.3),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.5),
)


METRICS = (
    "n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words",
)


def _covered(places: Column, width: int) -> Column:
    """How many words the windows at sorted, distinct ``places`` cover."""
    return F.aggregate(
        F.transform(places, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1) - p, F.lit(width)))),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b,
    )


def _repeats(keys: Column, same) -> Column:
    """Indexes ``k`` of sorted ``keys`` for which key ``k`` equals key ``k - 1``."""
    last = F.size(keys) - 1
    return F.when(last > 0, F.filter(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda k: same(F.get(keys, k - 1), F.get(keys, k)))).otherwise(
        F.array().cast("array<int>")
    )


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in ``words``.

    Windows are sorted by one long each: upper bits of a hash, lower bits the place. Equal
    neighbours are compared word by word; where two windows share the bits by chance, or
    a text has 2^24 words, the windows themselves are sorted instead.
    """
    windows = F.size(words) - 2
    places = F.sequence(F.lit(0), windows - 1)
    low = (1 << _PLACE_BITS) - 1

    def place(key):
        return key.bitwiseAND(F.lit(low)).cast("int")

    def prefix(key):
        return F.shiftright(key, _PLACE_BITS)

    def word(i, d):
        return F.get(words, i + d)

    def equal(i, j):
        return (word(i, 0) == word(j, 0)) & (word(i, 1) == word(j, 1)) & (word(i, 2) == word(j, 2))

    def total(at: Column) -> Column:
        return let(F.sort_array(F.array_distinct(at)), lambda p: _covered(p, 3))

    def exact() -> Column:
        rows = F.sort_array(F.transform(places, lambda i: F.struct(F.concat_ws(" ", word(i, 0), word(i, 1), word(i, 2)).alias("w"), i.alias("p"))))
        return let(
            rows,
            lambda s: let(
                _repeats(s, lambda x, y: x["w"] == y["w"]),
                lambda k: total(F.concat(F.transform(k, lambda x: F.get(s, x - 1)["p"]), F.transform(k, lambda x: F.get(s, x)["p"]))),
            ),
        )

    def fast(s: Column) -> Column:
        return let(
            _repeats(s, lambda x, y: prefix(x) == prefix(y)),
            lambda k: F.when(
                F.exists(k, lambda x: ~equal(place(F.get(s, x - 1)), place(F.get(s, x)))),
                exact(),
            ).otherwise(total(F.concat(F.transform(k, lambda x: place(F.get(s, x - 1))), F.transform(k, lambda x: place(F.get(s, x)))))),
        )

    keys = F.sort_array(
        F.transform(places, lambda i: F.xxhash64(word(i, 0), word(i, 1), word(i, 2)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint")))
    )
    return F.when(windows < 2, F.lit(0).cast("bigint")).when(windows > low, exact()).otherwise(let(keys, fast))


def metrics(text: Column) -> Column:
    """One struct with all counts of a text; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    stops = sorted({w for line in STOP_WORDS.values() for w in line.split()})

    def count(pattern):
        return F.regexp_count(text, F.lit(pattern)).cast("bigint")

    def of(words: Column) -> Column:
        return let(
            F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            lambda lines: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                count(r"[#*$%&|<>]").alias("n_symbols"),
                count(r"!").alias("n_exclamations"),
                F.size(F.filter(words, lambda w: F.lower(w).isin(stops))).cast("bigint").alias("n_stop_words"),
                F.size(lines).cast("bigint").alias("n_lines"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
                F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))).cast("bigint").alias("n_bullet_lines"),
                F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("bigint").alias("n_ellipsis_lines"),
                repeat_words(words).alias("n_repeat_words"),
            ),
        )

    return let(split_words(text), of)


def broken_rules(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that the counts ``m`` break, in the table's order."""

    def broken(rule: Rule) -> Column:
        value = m[rule.numerator].cast("double")
        if rule.denominator:
            value = F.when(m[rule.denominator] > 0, value / m[rule.denominator]).otherwise(0.0)
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        return F.when(bad, F.lit(rule.name))

    return F.filter(F.array(*[broken(r) for r in rules]), lambda x: x.isNotNull())


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row its id, all counts, ``base_failed``, ``broken`` (rule names) and ``kept``.

    Row by row and without a shuffle: null and empty texts have no words and fail; repeated
    rows give repeated rows; null ids stay null; other columns of ``df`` are not looked at.
    """

    def judged(m: Column) -> Column:
        broken = broken_rules(m, rules)
        kept = ~base_failed(m) & (F.size(broken) == 0)
        counts = [m[name].alias(name) for name in METRICS]
        return F.struct(*counts, base_failed(m).alias("base_failed"), broken.alias("broken"), kept.alias("kept"))

    # One expression, so that a filter on a result repeats it once, not for every count that the result is made of.
    return df.select(F.col(id_col), let(metrics(F.col(text_col)), judged).alias("_judged")).select(id_col, "_judged.*")


def keep_good(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of ``df`` that pass, with all their columns; one filter expression."""
    verdict = let(metrics(F.col(text_col)), lambda m: ~base_failed(m) & (F.size(broken_rules(m, rules)) == 0))
    return df.filter(verdict)
