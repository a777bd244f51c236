"""Words, word windows and fresh columns, as built-in column functions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def text_of(column: str | Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, everything else untouched."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def space_words(text: Column) -> Column:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and return."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def stretch(array: Column, start: int, length: Column) -> Column:
    """``length`` elements from the 0-based ``start``; a negative length is none."""
    return F.slice(array, start + 1, F.greatest(length, F.lit(0)))


def with_windows(df: DataFrame, words: str, lengths: list[int], out: str = "h") -> DataFrame:
    """Add a column ``{out}{n}`` for each n: the hash of the n words from every position.

    Hashes of longer windows are made from those of shorter ones, so that n words cost
    about 2 log2(n) hashes a position, not n. Each step is a projection of its own:
    Catalyst keeps projections apart whose columns are used more than once.
    """
    df = df.withColumn(f"{out}1", F.transform(words, lambda w: F.xxhash64(w)))
    have = {1}
    for n in sorted({*lengths}):
        df = _window(df, n, have, out)
    return df.drop(*[f"{out}{n}" for n in have - {*lengths}])


def _window(df: DataFrame, n: int, have: set[int], out: str) -> DataFrame:
    if n in have:
        return df
    left = 1 << (n.bit_length() - 1)
    left = left // 2 if left == n else left
    right = n - left
    df = _window(_window(df, left, have, out), right, have, out)
    first, second = F.col(f"{out}{left}"), F.col(f"{out}{right}")
    count = F.size(F.col(f"{out}1")) - (n - 1)
    have.add(n)
    return df.withColumn(
        f"{out}{n}",
        F.zip_with(stretch(first, 0, count), stretch(second, left, count), lambda a, b: F.xxhash64(a, b)),
    )


def hidden(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` in one struct: whatever is added beside it cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
