"""Small building blocks over Spark's higher-order functions."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use the result many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_of(items: Column) -> Column:
    """First element, NULL when there is none."""
    return F.get(items, F.lit(0))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def empty_to_null(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def empty_array() -> Column:
    return F.array().cast("array<string>")


def unique_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """Keep the first element for each key, in order."""
    both = F.struct(items.alias("items"), F.transform(items, key).alias("keys"))
    return bind(
        both,
        lambda b: F.filter(
            b["items"],
            lambda x, i: F.array_position(b["keys"], key(x)) == (i + 1),
        ),
    )


_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(col: Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.btrim(col, F.lit(_WHITESPACE))
