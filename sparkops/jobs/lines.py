"""Text-line jobs: avocado statistics, the access-log report and JSON
product lines. The lines are parsed into typed columns by Spark (CSV /
JSON parsers), then everything is DataFrame aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkops.functions.dates import RU_WEEKDAYS, month_of, weekday_name
from sparkops.jobs import fixed
from sparkops.functions.numeric import int_avg
from sparkops.operators.aggregate import count_by, mode, top_groups
from sparkops.sources.readers import decode_json_lines, parse_csv_lines, read_lines

def avocado(spark: SparkSession, path: str, after: str = fixed.AVOCADO_AFTER) -> dict[str, DataFrame]:
    """Results over avocado sales lines (header line starts 'id').

    totals: number of distinct regions, max and min avgPrice, in one pass;
    after_date: sales dated after ``after`` (ISO text comparison); top_month:
    most frequent month of the dates with 3 parts; region_avg_volume: average
    volume per region, rounded half-up to 2.
    """
    sales = parse_csv_lines(read_lines(spark, path), fixed.AVOCADO_SCHEMA, header_value="id").select(
        "id", "date", "avgPrice", "volume", "year", "region")
    months = sales.select(month_of("date").alias("month"))
    return {
        "totals": sales.agg(F.count_distinct("region").alias("regions"), F.max("avgPrice").alias("max_price"),
                            F.min("avgPrice").alias("min_price")),
        "after_date": sales.filter(F.col("date") > after),
        "top_month": mode(months, "month"),
        "region_avg_volume": sales.groupBy("region").agg(F.round(F.avg("volume"), 2).alias("avg_volume")),
    }


def access_log(spark: SparkSession, path: str, status: str = fixed.LOG_STATUS, top: int = fixed.LOG_TOP,
               names: Sequence[str] = RU_WEEKDAYS, keep_quotes: bool = False) -> dict[str, DataFrame]:
    """Report over access-log lines ``id,host,time,method,url,response,bytes``
    (quoted cells may hold commas; lines with an empty id are skipped).

    totals: one row, from one pass: total / loaded / skipped lines, sum, integer
    average, max and min of bytes, distinct hosts; responses: lines per
    response code, most first; top_hosts: the ``top`` busiest hosts;
    top_weekdays: weekdays (named by ``names``, Monday first) with most
    ``status`` responses, time being epoch seconds in the session zone.
    ``keep_quotes=True`` keeps quote characters in cells, as the original
    report printed them.
    """
    lines = read_lines(spark, path).withColumn("loaded", F.coalesce(F.substring_index("value", ",", 1) != "", F.lit(False)))
    rows = parse_csv_lines(lines, fixed.LOG_SCHEMA, keep_quotes=keep_quotes, keep=["loaded"])
    logs = rows.filter("loaded")
    days = (logs.filter(F.col("response") == status)
            .select(weekday_name(F.timestamp_seconds("time"), names).alias("name")))
    size, n = F.when(F.col("loaded"), F.col("bytes")), F.count(F.lit(1))
    totals = rows.agg(n.alias("total"), F.count_if("loaded").alias("loaded"), F.sum(size).alias("bytes"),
                      F.count(size).alias("_n"), F.max(size).alias("largest"), F.min(size).alias("smallest"),
                      F.count_distinct(F.when(F.col("loaded"), F.col("host"))).alias("hosts"))
    return {
        "totals": totals.select("total", "loaded", (F.col("total") - F.col("loaded")).alias("skipped"), "bytes",
                                int_avg("bytes", "_n").alias("average"), "largest", "smallest", "hosts"),
        "responses": count_by(logs.select(F.col("response").alias("name")), "name")
        .orderBy(F.desc("count"), "name"),
        "top_hosts": top_groups(logs.select(F.col("host").alias("name")), "name", top),
        "top_weekdays": top_groups(days, "name", top),
    }


def products(spark: SparkSession, path: str) -> DataFrame:
    """JSON product lines; lines that are not JSON or carry a value of
    the wrong type are dropped, missing fields get '' (or 0 reviews)."""
    return decode_json_lines(read_lines(spark, path), fixed.PRODUCT_SCHEMA, defaults=fixed.PRODUCT_DEFAULTS)
