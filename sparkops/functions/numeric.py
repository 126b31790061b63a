"""Numeric helpers with the reference jobs' rounding conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkops._cols import as_col as _c


def int_avg(total: Column | str, count: Column | str) -> Column:
    """Integer ("truncated") average ``total div count`` as bigint.

    The jobs divide a Long sum by a Long count, which truncates toward zero;
    SQL ``div`` does the same, exactly, with no detour through double.
    A zero count gives null (no rows: no average) instead of an error.
    """
    n = _c(count).cast("bigint")
    return F.when(n != 0, F.call_function("div", _c(total).cast("bigint"), n))


def avg_null_zero(c: Column | str) -> Column:
    """Average where a missing value counts as 0.0 (sum / number of rows)."""
    return F.avg(F.coalesce(_c(c).cast("double"), F.lit(0.0)))

