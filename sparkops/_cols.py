"""Argument normalisation shared by the operator modules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    """A column given by name or as a Column."""
    return F.col(c) if isinstance(c, str) else c


def as_list(x: str | Sequence[str]) -> list[str]:
    """One column name or several, as a list."""
    return [x] if isinstance(x, str) else list(x)
