"""Exact distinct counts from stored bitmaps.

A bitmap table holds, per group and range of 32,768 key values, one bit for each
value that occurs. Bitmaps of other groups, days or files are merged by OR, so a
distinct count over any union needs no second look at the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkops._cols import as_list

BUCKET, BITMAP = "bucket", "bitmap"


def build_bitmaps(df: DataFrame, by: str | Sequence[str], col: str) -> DataFrame:
    """``by``, ``bucket``, ``bitmap``: the values of the whole-number column ``col`` that occur
    per group. Null values leave no bit, but their group stays (with a null bucket).
    Bits are set map-side; what is shuffled is at most 4 KB a group, bucket and task."""
    keys = as_list(by)
    some = df.select(*keys, F.col(col).cast("bigint").alias("_v"))
    bits = some.groupBy(*keys, F.bitmap_bucket_number("_v").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias(BITMAP))
    return bits


def merge_bitmaps(*tables: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """The union of bitmap tables, per group of ``by`` (fewer groups than the tables have,
    none for one over all)."""
    keys = as_list(by)
    every = tables[0].select(*keys, BUCKET, BITMAP)
    for t in tables[1:]:
        every = every.unionByName(t.select(*keys, BUCKET, BITMAP))
    return every.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def bitmap_counts(bitmaps: DataFrame, by: str | Sequence[str] = (), name: str = "count") -> DataFrame:
    """Distinct non-null values per group of ``by``, exactly."""
    keys = as_list(by)
    bits = F.when(F.col(BUCKET).isNotNull(), F.bitmap_count(BITMAP)).otherwise(F.lit(0))
    total = F.coalesce(F.sum(bits), F.lit(0)).cast("bigint").alias(name)
    merged = merge_bitmaps(bitmaps, by=keys)
    return merged.groupBy(*keys).agg(total) if keys else merged.agg(total)
