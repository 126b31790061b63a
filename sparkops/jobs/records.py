"""Record-cleaning jobs: null defaults, job reviews, cars, position search
and the pizza order summary.

CSV inputs are type-inferred like the original programs unless ``schema``
(DDL of the whole file) is passed, which saves the inference pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkops.functions.dates import DEFAULT_DATE_FORMATS, parse_date_any, whole_years
from sparkops.functions.numeric import avg_null_zero
from sparkops.functions.text import clean_text, leading_int, prefix_any
from sparkops.jobs import fixed
from sparkops.operators.aggregate import attach_global, total_and_mode
from sparkops.operators.ranking import top_entity_extremes
from sparkops.operators.shape import conform, fill_text
from sparkops.sources.readers import read_csv
from sparkops.sources.writers import write_table

# What a missing value becomes: that of another column, or a fixed one.
_SHOES_FROM = {"item_after_discount": "item_price"}
_SHOES_VALUES = {"item_rating": fixed.SHOES_RATING_DEFAULT, "buyer_gender": fixed.SHOES_GENDER_DEFAULT}
_SHOES_REQUIRED = ("item_name", "item_category")


def clean(df: DataFrame, schema: str, copied: dict[str, str], values: dict[str, object], required: Sequence[str],
          fill: str) -> DataFrame:
    """A declared record from raw columns: rows lacking a required value go,
    missing values are ``copied`` from another column or take the column's value,
    text without either becomes ``fill``, and everything is bound to the declared
    types. Columns that were read as numbers keep their nulls."""
    names = T.StructType.fromDDL(schema).names
    defaults = {c: F.col(x) for c, x in copied.items()} | {c: F.lit(v) for c, v in values.items()}
    some = df.na.drop(subset=list(required))
    filled = some.select(*[F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c) for c in names])
    return conform(fill_text(filled, fill, [c for c in names if c not in defaults]), schema)


def shoes(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A discount price defaults to the price, rating and gender to fixed
    values, other text to 'n/a'; rows without name or category are dropped."""
    return clean(read_csv(spark, path, schema), fixed.SHOES_SCHEMA, _SHOES_FROM, _SHOES_VALUES, _SHOES_REQUIRED,
                 fixed.SHOES_FILL)


def job_reviews(spark: SparkSession, path: str, drop_null_location: bool = False) -> DataFrame:
    """The company and the job title with most reviews, and for
    each the location with the most and the fewest reviews.

    Rows without a review text are dropped; "2,933 reviews" counts 2933;
    line breaks inside names are removed and a missing name is ''. Empty
    names never win; null locations never are extremes. With
    ``drop_null_location`` rows without a location are dropped first (the
    typed variant of the job). Output: name, type, location, count,
    count_type.
    """
    df = read_csv(spark, path, schema=fixed.JOB_REVIEWS_SCHEMA, multiline=True)
    df = df.na.drop(subset=["CompanyReviews"] + (["Location"] if drop_null_location else []))
    df = df.select(clean_text("JobTitle").alias("job"), clean_text("Company").alias("company"),
                   "Location", leading_int("CompanyReviews").alias("reviews"))
    return top_entity_extremes(df, {"company": "company", "job": "job"}, "Location", "reviews")


def cars(spark: SparkSession, path: str, as_of: str | None = None,
         formats: Sequence[str] = DEFAULT_DATE_FORMATS, schema: str | None = None) -> DataFrame:
    """Every car with the fleet's average mileage (missing = 0) and the
    whole years since purchase. Purchase dates may use any of ``formats``;
    an unparseable or missing date counts as ``as_of`` (default today)."""
    df = conform(read_csv(spark, path, schema).withColumnRenamed("type", "types"), fixed.CAR_SCHEMA)
    mean = df.agg(avg_null_zero("mileage").alias("avg_mileage"))
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    bought = parse_date_any("date_of_purchase", formats, today)
    return attach_global(df, mean).withColumn("years_since_purchase", whole_years(bought, today))


def positions(spark: SparkSession, path: str, prefixes: Sequence[str] = fixed.POSITION_PREFIXES,
              schema: str | None = None) -> DataFrame:
    """Distinct positions whose title starts with any prefix, ignoring
    case, ordered by PositionID."""
    df = conform(read_csv(spark, path, schema), fixed.POSITION_SCHEMA)
    return df.filter(prefix_any("Position", prefixes)).distinct().orderBy("PositionID")


def pizza(spark: SparkSession, in_path: str, out_path: str | None = None,
          schema: str | None = None) -> DataFrame:
    """Per order type the number of orders, the address with most
    orders (ties -> smallest id) and its count; optionally saved as CSV
    without header."""
    df = conform(read_csv(spark, in_path, schema), fixed.PIZZA_SCHEMA)
    out = total_and_mode(df, "order_type", "address_id", "orders_total", "address_id", "orders_cnt")
    if out_path:
        write_table(out, out_path, "csv")
    return out
