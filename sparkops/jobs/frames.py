"""DataFrame basics: local tables, declared-schema JSON/CSV scans, projections,
flags, min/max, shifted age bands and the two-season word count.

Jobs that read CSV infer column types like the original programs unless a
``schema`` (DDL of the whole file, in column order) is given; at scale, pass
it: inference is an extra full pass over the input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkops.functions.text import flag
from sparkops.jobs import fixed
from sparkops.operators.aggregate import group_extremes
from sparkops.operators.ranking import word_count, zip_by_rank
from sparkops.sources.readers import first_cell, local_rows, read_csv, read_json, read_tagged
from sparkops.sources.writers import write_table

def videos(spark: SparkSession, rows: Sequence[Sequence[str]]) -> DataFrame:
    """Video records given as local tuples -> named table."""
    return local_rows(spark, rows, fixed.VIDEO_COLUMNS)


def restaurants(spark: SparkSession, path: str) -> DataFrame:
    """Restaurant JSON lines read with the declared nested schema."""
    return read_json(spark, path, fixed.RESTAURANT_SCHEMA)


def movies(spark: SparkSession, path: str, out_path: str | None = None) -> DataFrame:
    """Movies CSV with a declared 16-column schema (bad cells -> null),
    optionally saved as parquet."""
    df = read_csv(spark, path, schema=fixed.MOVIES_SCHEMA)
    if out_path:
        write_table(df, out_path)
    return df


def bike_projection(spark: SparkSession, path: str, n: int = fixed.BIKE_ROWS,
                    schema: str | None = None) -> DataFrame:
    """Four weather columns of the first ``n`` rows."""
    return read_csv(spark, path, schema).select("Hour", "TEMPERATURE", "HUMIDITY", "WIND_SPEED").limit(n)


def bike_workday(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Distinct (HOLIDAY, FUNCTIONING_DAY, is_workday); a day is not a
    workday (0) only when it is a holiday and not a functioning day."""
    df = read_csv(spark, path, schema)
    off = (F.col("HOLIDAY") == fixed.BIKE_HOLIDAY) & (F.col("FUNCTIONING_DAY") == fixed.BIKE_NOT_FUNCTIONING)
    return df.withColumn("is_workday", flag(off, 0, 1)).select("HOLIDAY", "FUNCTIONING_DAY", "is_workday").distinct()


def bike_min_max(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Min and max temperature per date."""
    return group_extremes(read_csv(spark, path, schema), "Date", "TEMPERATURE", "min_temp", "max_temp")


def mall_income(spark: SparkSession, path: str, out_path: str | None = None,
                shift: int = fixed.MALL_AGE_SHIFT, low: int = fixed.MALL_AGE_LOW,
                high: int = fixed.MALL_AGE_HIGH, schema: str | None = None) -> DataFrame:
    """Ages shifted by ``shift``, kept in [low, high]; average income per
    (Gender, Age) rounded half-even to 1 digit, gender_code 1 for Male."""
    # Filter on the unshifted age (same rows, and the scan can apply it).
    df = read_csv(spark, path, schema).where(F.col("Age").between(low - shift, high - shift))
    out = (df.withColumn("Age", F.col("Age") + shift)
           .groupBy("Gender", "Age")
           .agg(F.bround(F.avg("Annual Income (k$)"), 1).alias("avg_Annual_Income"))
           .withColumn("gender_code", flag(F.col("Gender") == fixed.MALL_CODE_ONE_GENDER))
           .orderBy("Gender", "Age"))
    if out_path:
        write_table(out, out_path)
    return out


def season_word_ranks(spark: SparkSession, paths: Mapping[str, str], limit: int = fixed.WORD_RANK_LIMIT,
                      out_path: str | None = None) -> DataFrame:
    """Word counts of two subtitle files aligned by rank
    (``w_s1, cnt_s1, id, w_s2, cnt_s2``, ids 0..limit).

    Only the first cell of a line counts (the text before its first comma, or
    inside its quotes), as in the original job, which read headerless CSV. It
    is cut from the raw line, so the number of cells doesn't matter. Both
    files are read in one scan and counted in one aggregation, by season.
    """
    lines = read_tagged(spark, paths, tag="season").select("season", first_cell("value").alias("text"))
    counts = word_count(lines, "text", by=["season"], word_col="value", count_col="count")
    out = zip_by_rank(counts, "season", list(paths), "value", "count", limit)
    if out_path:
        write_table(out, out_path, "json")
    return out
