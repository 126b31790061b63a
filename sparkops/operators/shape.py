"""Row shaping: constant columns, schema conformance, null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_constants(df: DataFrame, n: int, value: str = "n/a", prefix: str = "col_") -> DataFrame:
    """Append ``prefix1 .. prefixN`` constant columns in ONE projection."""
    return df.select("*", *[F.lit(value).alias(f"{prefix}{i}") for i in range(1, n + 1)])


def conform(df: DataFrame, schema: T.StructType | str,
            required: Sequence[str] = ()) -> DataFrame:
    """Bind rows to a declared record type.

    Columns are picked by name (case-insensitively, as Spark resolves them),
    put in declared order and cast; a value that does not fit becomes null
    instead of failing the job. Rows with a null in ``required`` are dropped.
    """
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    src = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = df.select(*[_cast(F.col(f.name), src.get(f.name.lower()), f.dataType).alias(f.name)
                      for f in st.fields])
    if required:
        out = out.na.drop(subset=list(required))
    return out


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Every text Spark can cast to an integer matches this (ASCII digits, a sign,
# blanks or control characters around them).
_INTEGER_TEXT = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"


def _cast(c, source, target):
    if source == target:
        return c
    if isinstance(source, T.StringType) and isinstance(target, _INTEGRAL):
        # A failing text-to-integer cast is exception-driven in Spark (about
        # 20x a success); texts that cannot be integers skip it.
        return F.when(c.rlike(_INTEGER_TEXT), c.try_cast(target))
    return c.try_cast(target)


def fill_text(df: DataFrame, value: str, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by ``value`` in the listed columns.

    Like Spark's ``na.fill``, only string columns are filled: a listed
    numeric column is left as it is.
    """
    return df.na.fill(value, subset=list(cols))


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows that have a null in any of ``cols``."""
    return df.na.drop(how="any", subset=list(cols))
