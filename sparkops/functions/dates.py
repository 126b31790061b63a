"""Date helpers: multi-format parsing, whole years, weekday names, ISO text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkops._cols import as_col as _c

# Fixed values (must equal the reference jobs' behaviour).
# Date patterns tried in order by the car job. Its first pattern,
# "dd/mm/yyyy", uses minutes ("mm") and can never produce a date there, so it
# is left out; in Spark it would wrongly succeed. Callers may add "dd/MM/yyyy".
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd", "yyyy MM dd", "yyyy-MMM-dd", "yyyy MMM dd")

# Russian weekday names, capitalised, Monday first.
RU_WEEKDAYS = ("Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье")


def _shape(fmt: str) -> str | None:
    """A regex every text parsable with ``fmt`` matches (a necessary
    condition), or None when the pattern has fields this does not model."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch == "y":
            out.append(r"[+-]?\d+")
        elif ch in "Md" and run <= 2:
            out.append(r"\d{1,2}")
        elif ch == "M":
            out.append(r"[^\d\s]+")
        elif ch.isalpha() or ch == "'":
            return None
        else:
            out.append(re.escape(fmt[i:j]))
        i = j
    return "^" + "".join(out) + "$"


def _try_date(col: Column, fmt: str) -> Column:
    # A failed parse raises inside Spark and costs microseconds; a text that
    # does not even have the pattern's shape is skipped with a cheap regex.
    shape = _shape(fmt)
    parsed = F.try_to_date(col, fmt)
    return parsed if shape is None else F.when(col.rlike(shape), parsed)


def parse_date_any(c: Column | str, formats: Sequence[str] = DEFAULT_DATE_FORMATS,
                   as_of: Column | str | None = None) -> Column:
    """First pattern that parses the text wins; none (or null text) -> ``as_of``.

    ``as_of`` defaults to ``current_date()``. Parsing is strict: an impossible
    date such as 2021-02-30 does not parse.
    """
    col = _c(c)
    fallback = F.current_date() if as_of is None else (
        F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)
    return F.coalesce(*[_try_date(col, f) for f in formats], fallback)


def whole_years(start: Column | str, end: Column | str) -> Column:
    """Completed years from ``start`` to ``end`` (calendar-period semantics).

    Counts whole months, minus one when the end day has not reached the
    start day (plus one for negative spans), then truncates to years: a
    2020-02-29 start reaches one year only on 2021-03-01.
    """
    s, e = _c(start), _c(end)
    months = (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))
    days = F.dayofmonth(e) - F.dayofmonth(s)
    months = (F.when((months > 0) & (days < 0), months - 1)
              .when((months < 0) & (days > 0), months + 1)
              .otherwise(months))
    return F.call_function("div", months.cast("bigint"), F.lit(12).cast("bigint"))


def weekday_name(c: Column | str, names: Sequence[str] = RU_WEEKDAYS) -> Column:
    """Name of the weekday of a date/timestamp; ``names`` start on Monday.

    Epoch seconds should be converted first with ``F.timestamp_seconds``
    (interpreted in the session time zone).
    """
    table = F.array(*[F.lit(n) for n in names])
    return F.element_at(table, F.weekday(_c(c)) + 1)


def iso_date_text(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text of a date or timestamp."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def month_of(c: Column | str) -> Column:
    """Month part of ``yyyy-MM-dd`` text; null unless it has exactly 3 parts."""
    col = _c(c)
    parts = F.split(col, "-")
    return F.when((col != "") & (F.size(parts) == 3), parts.getItem(1))
