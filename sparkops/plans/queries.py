"""Registered queries: each operator of the inventory exercised on the
driver's parquet tables. Every callable is ``(spark, sf_dir) -> DataFrame``.

Queries that test a reader or writer first write their input (derived from
the tables, by Spark) below the session's shared checkpoint folder, then
return the lazy read of it. Nothing here collects data on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkops.functions import dates, text
from sparkops.jobs import __main__ as launcher
from sparkops.jobs import fixed
from sparkops.jobs import frames as season_jobs
from sparkops.functions.numeric import avg_null_zero
from sparkops.operators import aggregate as agg
from sparkops.operators import bitmaps, heavy, joins, ranking, shape
from sparkops.session import scratch_path
from sparkops.sources import readers, records, writers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


# ---------------------------------------------------------------- sources

def local_rows(spark, d):
    # A local code table (S1), columns named by position (P6), used as a
    # lookup on orders; the 3-row table is broadcast by construction.
    codes = readers.local_rows(spark, [("F", "finished"), ("O", "open"), ("P", "partial")],
                               ["o_orderstatus", "status_name"])
    orders = table(spark, d, "orders").select("o_orderstatus")
    return (orders.join(F.broadcast(codes), "o_orderstatus")
            .groupBy("status_name").agg(F.count(F.lit(1)).alias("orders")))


def json_scan_nested(spark, d):
    path = scratch_path(spark, "json_nested")
    orders = table(spark, d, "orders")
    writers.write_table(orders.select("o_orderkey", F.struct(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").alias("cust")).alias("info")), path, "json")
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("info", T.StructType([
            T.StructField("status", T.StringType()),
            T.StructField("priority", T.StringType()),
            T.StructField("cust", T.LongType())]))])
    return readers.read_json(spark, path, schema).select("o_orderkey", "info.*")


PART_SCHEMA = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
               "p_size INT, p_retailprice DOUBLE")


def csv_scan_typed(spark, d):
    path = scratch_path(spark, "csv_typed")
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    writers.write_table(part, path, "csv", header=True)
    return readers.read_csv(spark, path, schema=PART_SCHEMA)


def csv_scan_inferred(spark, d):
    path = scratch_path(spark, "csv_inferred")
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    writers.write_table(cust, path, "csv", header=True)
    return readers.read_csv(spark, path)


def csv_scan_multiline(spark, d):
    path = scratch_path(spark, "csv_multiline")
    docs = table(spark, d, "documents").select("doc_id", "text")
    # Files with line breaks in cells aren't split: bound their rows.
    writers.write_table(docs, path, "csv", header=True, quoteAll="true", escape='"', maxRecordsPerFile="20000")
    return readers.read_csv(spark, path, schema="doc_id BIGINT, text STRING", multiline=True, empty_as_null=False)


def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "parquet")
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    writers.write_table(cust, path)
    writers.write_table(cust, path)  # overwrite, not append
    return spark.read.parquet(path)


def json_roundtrip(spark, d):
    path = scratch_path(spark, "json")
    writers.write_table(table(spark, d, "nation"), path, "json")
    writers.write_table(table(spark, d, "nation"), path, "json")
    return readers.read_json(spark, path, "n_nationkey INT, n_name STRING, n_regionkey INT")


def csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    # Empty text, blanks at the ends and null are told apart.
    key, text_ = F.col("r_regionkey"), F.col("r_name")
    name = (F.when(key == 0, "").when(key == 1, F.concat(F.lit("  "), text_, F.lit(" "))).when(key != 2, text_))
    writers.write_table(table(spark, d, "region").select("r_regionkey", name.alias("r_name")), path, "csv")
    return readers.read_csv(spark, path, schema="r_regionkey INT, r_name STRING", header=False, empty_as_null=False)


def _write_lines(spark, df: DataFrame, tag: str) -> str:
    path = scratch_path(spark, tag)
    writers.write_table(df.select(F.col("line").alias("value")), path, "text")
    return path


def csv_quoted_lines(spark, d):
    part = table(spark, d, "part")
    lines = part.select(F.format_string('%d,"%s, %s",%d', "p_partkey", "p_name", "p_type", "p_size").alias("line"))
    path = _write_lines(spark, lines, "quoted_lines")
    return readers.parse_csv_lines(readers.read_lines(spark, path), "id BIGINT, host STRING, bytes INT")


def csv_delimited_lines(spark, d):
    path = scratch_path(spark, "delimited")
    supp = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    writers.write_table(supp, path, "csv", header=True)  # every part file starts with a header line
    return readers.parse_csv_lines(readers.read_lines(spark, path),
                                   "s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE",
                                   header_value="s_suppkey")


def csv_pipe_lines(spark, d):
    # A separator that means something in a regex; a header line by its value.
    supp = table(spark, d, "supplier")
    name = F.concat(F.lit('"'), "s_name", F.lit('|x"'))
    lines = supp.select(F.concat_ws("|", F.col("s_suppkey").cast("string"), name,
                                    F.col("s_nationkey").cast("string")).alias("line"))
    header = table(spark, d, "region").filter("r_regionkey = 0").select(F.lit("id|name|nation").alias("line"))
    path = _write_lines(spark, lines.union(header), "pipe_lines")
    return readers.parse_csv_lines(readers.read_lines(spark, path), "id BIGINT, name STRING, nation INT", sep="|",
                                   header_value="id")


def load_accounting(spark, d):
    part = table(spark, d, "part")
    first = F.when(F.col("p_partkey") % 10 == 0, F.lit("")).otherwise(F.col("p_partkey").cast("string"))
    lines = part.select(F.concat_ws(",", first, F.col("p_size").cast("string")).alias("line"))
    path = _write_lines(spark, lines, "accounting")
    return readers.load_accounting(readers.read_lines(spark, path))


def json_lines_decode(spark, d):
    ev = table(spark, d, "events")
    line = F.when(F.col("event_id") % 7 == 0, F.lit("not json")).otherwise(
        F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", "),
                 F.expr("substring(props, 2)")))
    path = _write_lines(spark, ev.select(line.alias("line")), "json_lines")
    return readers.decode_json_lines(readers.read_lines(spark, path), "event_id BIGINT, k INT")


def json_lines_defaults(spark, d):
    ev = table(spark, d, "events")
    props = F.when(F.col("event_id") % 3 == 0, F.lit("{}")).otherwise(F.expr("substring(props, 2)"))
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"),
                    F.when(props == "{}", F.lit("}")).otherwise(F.concat(F.lit(", "), props)))
    path = _write_lines(spark, ev.select(line.alias("line")), "json_defaults")
    return readers.decode_json_lines(readers.read_lines(spark, path), "event_id BIGINT, k INT",
                                     defaults={"k": 0})


# ---------------------------------------------------------------- shaping

def project_topk(spark, d):
    li = table(spark, d, "lineitem")
    return (li.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(3)
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))


def case_when_distinct(spark, d):
    o = table(spark, d, "orders")
    workday = text.flag((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"), 0, 1)
    return o.select("o_orderstatus", "o_orderpriority", workday.alias("is_workday")).distinct()


def _part_with_nulls(spark, d):
    # Nulls made on purpose: type, size, brand and name each lose one value.
    p = table(spark, d, "part")
    return p.select("p_partkey", "p_brand", "p_name",
                    F.nullif("p_type", F.lit("ECONOMY")).alias("type_n"),
                    F.nullif("p_size", F.lit(11)).alias("size_n"),
                    F.nullif("p_brand", F.lit("Brand#2")).alias("brand_n"),
                    F.nullif("p_name", F.lit("small ring")).alias("name_n"))


def null_defaults(spark, d):
    p = _part_with_nulls(spark, d).filter(F.col("name_n").isNotNull())
    out = p.select("p_partkey",
                   F.coalesce("type_n", "p_brand").alias("type_or_brand"),
                   F.coalesce("size_n", F.lit(0)).alias("size_or_zero"),
                   F.col("brand_n").alias("brand"))
    # size_or_zero is numeric: na.fill with text leaves it as it is.
    return shape.fill_text(out, "n/a", ["brand", "size_or_zero"])


def na_drop_subset(spark, d):
    p = shape.drop_incomplete(_part_with_nulls(spark, d), ["size_n", "brand_n"])
    return p.select("p_partkey", "p_name")


def leading_int(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", text.leading_int("o_orderpriority", "-").alias("n"),
                    text.leading_int("o_orderstatus", "-").alias("bad"))


def strip_newlines(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", text.clean_text("text").alias("text"))


def rename_drop(spark, d):
    return table(spark, d, "nation").withColumnRenamed("n_name", "names").drop("n_regionkey")


def conform_schema(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"),
                                       F.col("p_name").alias("name"))
    return shape.conform(p, "id INT, size BIGINT, name STRING")


def prefix_filter_distinct(spark, d):
    c = table(spark, d, "customer")
    return (c.filter(text.prefix_any("c_mktsegment", ["BU", "ma"]))
            .select("c_nationkey", "c_mktsegment").distinct())


def date_string_filter(spark, d):
    o = table(spark, d, "orders")
    # Same as ISO-text > '2001-02-11', written on the typed column so the
    # parquet scan can skip row groups.
    return (o.filter(F.col("o_orderdate") >= _ntz("2001-02-12 00:00:00"))
            .select("o_orderkey", dates.iso_date_text("o_orderdate").alias("d")))


def shift_between_bround(spark, d):
    # Band test on the unshifted column (28..33 before +2 is 30..35 after), so
    # the parquet scan can use it; then the column is replaced in place.
    p = table(spark, d, "part").filter(F.col("p_size").between(30 - 2, 35 - 2))
    return (p.withColumn("p_size", F.col("p_size") + 2)
            .groupBy("p_brand", "p_size").agg(F.bround(F.avg("p_partkey"), 1).alias("avg_price"))
            .withColumn("brand_code", text.flag(F.col("p_brand") == "Brand#1")))


# ---------------------------------------------------------------- aggregation

def group_min_max(spark, d):
    ev = table(spark, d, "events").select(F.to_date("ts").alias("dt"), "value")
    return agg.group_extremes(ev, "dt", "value", "min_value", "max_value")


def group_avg(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.avg("p_size").alias("avg_salary"))


def group_avg_round(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 2).alias("avg_volume"))


def group_sum(spark, d):
    c = table(spark, d, "customer")
    return c.groupBy("c_nationkey").agg(F.sum("c_custkey").cast("bigint").alias("sum_id"))


def group_count_sorted(spark, d):
    ev = table(spark, d, "events").select(F.col("event_type").alias("name"))
    return agg.count_by(ev, "name").orderBy(F.desc("count"), "name")


def top3_by_count(spark, d):
    ev = table(spark, d, "events").select(F.col("user_id").alias("name"))
    return agg.top_groups(ev, "name", 3)


def numeric_stats(spark, d):
    return agg.numeric_stats(table(spark, d, "part"), "p_size")


def distinct_count(spark, d):
    return agg.distinct_count(table(spark, d, "customer"), "c_nationkey", "regions")


def global_extremes(spark, d):
    p = table(spark, d, "part")
    return p.agg(F.max("p_retailprice").alias("max_price"), F.min("p_retailprice").alias("min_price"))


def global_extreme_records(spark, d):
    # The whole records at the highest and the lowest retail price.
    p = table(spark, d, "part")
    return agg.extreme_records(p, "p_retailprice", "p_partkey", ["p_partkey", "p_name", "p_retailprice"])


def avg_null_as_zero(spark, d):
    li = table(spark, d, "lineitem")
    return li.agg(avg_null_zero(F.nullif("l_quantity", F.lit(1.0))).alias("avg_mileage"))


def global_avg_attached(spark, d):
    li = table(spark, d, "lineitem")
    mean = li.agg(avg_null_zero(F.nullif("l_quantity", F.lit(1.0))).alias("avg_mileage"))
    return agg.attach_global(li.select("l_orderkey", "l_linenumber", "l_quantity"), mean)


def mode_month(spark, d):
    o = table(spark, d, "orders")
    months = o.select(dates.month_of(dates.iso_date_text("o_orderdate")).alias("month"))
    return agg.mode(months, "month")


def group_total_and_mode(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("order_type"),
                                         F.col("o_custkey").alias("address_id"))
    return agg.total_and_mode(o, "order_type", "address_id", "orders_total", "address_id", "orders_cnt")


def word_count(spark, d):
    return ranking.word_count(table(spark, d, "documents"), "text")


def topn_zip_by_rank(spark, d):
    docs = table(spark, d, "documents").filter(F.col("lang").isin("en", "fr"))
    counts = ranking.word_count(docs, "text", by=["lang"], word_col="w", count_col="n")
    return ranking.zip_by_rank(counts, "lang", ["en", "fr"], "w", "n", limit=20)


def season_word_ranks(spark, d):
    # The subtitle job end to end: English and French texts written as plain
    # text files (one write, partitioned by language), read back in one scan;
    # only the first cell of a line counts, as in a headerless CSV.
    path = scratch_path(spark, "subtitles")
    docs = table(spark, d, "documents").filter(F.col("lang").isin("en", "fr"))
    docs.select("lang", F.col("text").alias("value")).write.mode("overwrite").partitionBy("lang").text(path)
    return season_jobs.season_word_ranks(spark, {"en": f"{path}/lang=en", "fr": f"{path}/lang=fr"}, limit=20)


def top_entity_location_extremes(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("company"), F.col("l_linestatus").alias("job"),
        F.col("l_linenumber").cast("string").alias("location"),
        F.col("l_quantity").cast("int").alias("reviews"))
    return ranking.top_entity_extremes(li, {"company": "company", "job": "job"}, "location", "reviews")


def top3_weekdays_ru(spark, d):
    ev = table(spark, d, "events").filter(F.col("event_type") == "error")
    days = ev.select(dates.weekday_name("ts").alias("name"))
    return agg.top_groups(days, "name", 3)


def weekday_from_epoch(spark, d):
    # As the access log has it: epoch seconds, then the Russian weekday name.
    ev = table(spark, d, "events").select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"))
    return agg.count_by(ev.select(dates.weekday_name(F.timestamp_seconds("time")).alias("name")), "name")


def multi_format_years_since(spark, d):
    o = table(spark, d, "orders")
    fmt = F.col("o_orderkey") % 5
    as_text = (F.when(fmt == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
               .when(fmt == 1, F.date_format("o_orderdate", "yyyy MM dd"))
               .when(fmt == 2, F.date_format("o_orderdate", "yyyy-MMM-dd"))
               .when(fmt == 3, F.date_format("o_orderdate", "yyyy MMM dd"))
               .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))
    as_of = F.lit("2002-01-01").cast("date")
    bought = dates.parse_date_any(as_text, as_of=as_of)
    return o.select("o_orderkey", dates.whole_years(bought, as_of).alias("years"))


# ---------------------------------------------------------------- joins and set ops

def join_inner_using(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return shape.add_constants(o.join(c, "id"), 2)


def join_prepartitioned(spark, d):
    # Both sides hash-partitioned on the key they are joined by: the join
    # reuses that partitioning (2 exchanges, not 4). Without a fixed number of
    # partitions AQE may still coalesce them.
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey").repartition("id")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal").repartition("id")
    return o.join(c, "id")


def join_distinct_sorted(spark, d):
    o = table(spark, d, "orders").alias("r2")
    c = table(spark, d, "customer").alias("r1")
    j = o.join(c, F.col("r2.o_custkey") == F.col("r1.c_custkey"))
    wide = shape.add_constants(j.select("r1.c_custkey", "r1.c_name", "r2.o_orderpriority"), 2)
    return wide.distinct().sort(F.desc("c_custkey"), "o_orderpriority").limit(100)


def repartition_round_robin(spark, d):
    # Rows dealt by number, then counted by a key: the layout changes no result.
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey").repartition(5)
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("last"))


def range_source_join(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_quantity").cast("bigint").alias("id"))
    return spark.range(0, 60, 3).join(li, "id").groupBy("id").agg(F.count(F.lit(1)).alias("lines"))


def join_scaled_distinct(spark, d):
    o = table(spark, d, "orders").alias("r2")
    c = table(spark, d, "customer").alias("r1")
    j = o.join(c, F.col("r2.o_custkey") == F.col("r1.c_custkey"))
    return j.select(F.col("r2.o_custkey").alias("id"), (F.col("r2.o_totalprice") * 10).alias("price"),
                    F.regexp_replace(F.lit("abc"), "a", "b").alias("col_1"), F.col("r1.c_name")).distinct()


def join_global_avg(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("id"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return o.join(c, "id").agg(F.avg("id").alias("id2"))


def union_all_rows(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("salary"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("salary"))
    return c.union(s)


def join_broadcast_xor_count(spark, d):
    codes = readers.local_rows(spark, [("F", "yes"), ("O", "no"), ("P", "no")], ["id", "is_cancelled"])
    o = table(spark, d, "orders")
    return joins.xor_mismatches(o, F.broadcast(codes), o.o_orderstatus == codes.id,
                                o.o_orderpriority == "1-URGENT", codes.is_cancelled == "yes")


def cross_join_range(spark, d):
    return joins.replicate(table(spark, d, "region"), 4, "salt")


def salted_join_band_avg(spark, d):
    ev = table(spark, d, "events")
    freelancers = ev.select("event_id", "event_type", "user_id", (F.col("event_id") % 5).alias("level"))
    offers = ev.select("event_type", "user_id", (F.col("event_id") % 7).alias("level"),
                       F.round(F.col("value") * 100).cast("bigint").alias("price"))
    return joins.band_avg_join(freelancers, offers, ["event_type", "user_id"], "level", "level",
                               "event_id", "price", band=fixed.OFFER_LEVEL_BAND, id_name="id",
                               avg_name="avg_price_cents")


def salted_hot_key_join(spark, d):
    # Every event with the number of events of its type. The five event
    # types each hold about a fifth of the rows, more than a partition's fair
    # part, so their rows are spread over salts against copies of the small side.
    ev = table(spark, d, "events")
    per_type = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("type_events"))
    joined = joins.salted_join(ev.select("event_id", "event_type"), per_type, "event_type", "event_id")
    return joined.select("event_id", "event_type", "type_events")


def lookup_filter_basket(spark, d):
    nation, supplier, lineitem = (table(spark, d, t) for t in ("nation", "supplier", "lineitem"))
    country = "NATION_5"
    code = joins.lookup_key(nation, "n_name", country, "n_nationkey", "country_code")
    month = (lineitem.filter((F.col("l_shipdate") >= _ntz("1999-04-01 00:00:00"))
                             & (F.col("l_shipdate") < _ntz("1999-05-01 00:00:00")))
             .select("l_orderkey", "l_partkey", "l_suppkey"))
    tx = joins.lookup_filter(month, supplier.select("s_suppkey", "s_nationkey"),
                             F.col("s_nationkey") == code.scalar(), F.col("l_suppkey") == F.col("s_suppkey"))
    summary = agg.basket_summary(tx, "l_orderkey", "l_partkey")
    return summary.select(code.scalar().alias("country_code"), F.lit(country).alias("country_name"),
                          "most_popular_product", "avg_transaction")


def basket_result_roundtrip(spark, d):
    # The one-row result saved as a table and read back.
    path = scratch_path(spark, "basket")
    writers.write_table(lookup_filter_basket(spark, d), path)
    return spark.read.parquet(path)


def basket_per_group(spark, d):
    # The basket summary per order priority over all line items: most
    # popular part (ties -> smallest key) and items per order.
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    items = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return agg.basket_summary(items, "l_orderkey", "l_partkey", by="o_orderpriority")


# ---------------------------------------------------------------- at any size

def csv_scan_multiline_split(spark, d):
    path = scratch_path(spark, "csv_records")
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    writers.write_table(docs, path, "csv", header=True, quoteAll="true", escape='"')
    return records.read_csv_records(spark, path, "doc_id BIGINT, text STRING, source STRING", empty_as_null=False)


def full_rank_zip(spark, d):
    docs = table(spark, d, "documents").filter(F.col("lang").isin("en", "fr"))
    counts = ranking.word_count(docs, "text", by=["lang"], word_col="w", count_col="n")
    return ranking.zip_all_ranks(counts, "lang", ["en", "fr"], "w", "n")


def top3_heavy_hitters(spark, d):
    return heavy.heavy_groups(table(spark, d, "events"), "user_id", 3).withColumnRenamed("user_id", "name")


def bitmap_distinct_counts(spark, d):
    # Customers by order status and priority, stored once as bitmaps; per
    # priority and over all from those.
    path = scratch_path(spark, "bitmaps")
    orders = table(spark, d, "orders")
    writers.write_table(bitmaps.build_bitmaps(orders, ["o_orderstatus", "o_orderpriority"], "o_custkey"), path)
    stored = spark.read.parquet(path)
    each = bitmaps.bitmap_counts(stored, "o_orderpriority", "customers")
    return each.unionByName(bitmaps.bitmap_counts(stored, name="customers").withColumn("o_orderpriority", F.lit("all")))


def json_lines_strict(spark, d):
    ev = table(spark, d, "events")
    name, k = F.concat(F.lit('"'), "event_type", F.lit('"')), F.col("user_id").cast("string")
    kind = F.col("event_id") % 8
    name = F.when(kind == 1, "17").when(kind == 2, "null").otherwise(name)  # a number where text belongs
    k = (F.when(kind == 3, F.concat(F.lit('"'), k, F.lit('"'))).when(kind == 4, F.concat(k, F.lit(".5")))
         .when(kind == 5, F.concat(k, F.lit(".0"))).otherwise(k))
    body = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "name": '), name)
    line = F.when(kind == 6, F.concat(body, F.lit("}"))).when(kind == 7, body).otherwise(F.concat(body, F.lit(', "k": '), k, F.lit("}")))
    path = _write_lines(spark, ev.select(line.alias("line")), "json_strict")
    return readers.decode_json_strict(readers.read_lines(spark, path), "id BIGINT, name STRING, k INT", defaults={"k": 0})


def pruned_partition_basket(spark, d):
    # The basket of ``lookup_filter_basket`` from a fact stored by nation: the
    # nation's key is known at run time only, and prunes the folders read.
    path = scratch_path(spark, "fact_by_nation")
    nation, supplier, lineitem = (table(spark, d, t) for t in ("nation", "supplier", "lineitem"))
    fact = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey", "l_partkey", "l_shipdate", F.col("s_nationkey").alias("nation"))
    writers.write_partitions(fact, path, "nation")
    april = spark.read.parquet(path).filter((F.col("l_shipdate") >= _ntz("1999-04-01 00:00:00"))
                                            & (F.col("l_shipdate") < _ntz("1999-05-01 00:00:00")))
    tx = joins.lookup_filter(april, nation, F.col("n_name") == "NATION_5", F.col("nation") == F.col("n_nationkey"))
    code = joins.lookup_key(nation, "n_name", "NATION_5", "n_nationkey", "country_code")
    return agg.basket_summary(tx, "l_orderkey", "l_partkey").select(
        code.scalar().alias("country_code"), F.lit("NATION_5").alias("country_name"), "most_popular_product", "avg_transaction")


def runtime_filter_join(spark, d):
    # A dimension too big to broadcast whose filter leaves few keys: with the run-time
    # filters of ``session.scale_conf`` the fact drops the others before its shuffle.
    o = table(spark, d, "orders").filter("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    li = table(spark, d, "lineitem")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("lines"), F.max("l_shipdate").alias("last_ship")))


def bucketed_joins(spark, d):
    # Orders and customers stored once by the customer's key; both joins and the
    # aggregation between them run without a shuffle.
    o = writers.write_bucketed(table(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", "o_totalprice"),
                               scratch_path(spark, "orders_bucketed"), "id", 16)
    c = writers.write_bucketed(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_nationkey"),
                               scratch_path(spark, "customer_bucketed"), "id", 16)
    per = o.join(c, "id").groupBy("id", "c_nationkey").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest"))
    return per.join(o, "id").filter(F.col("o_totalprice") >= F.col("largest")).select("id", "c_nationkey", "orders", "o_orderkey")


def load_accounting_written(spark, d):
    part = table(spark, d, "part")
    first = (F.when(F.col("p_partkey") % 10 == 0, F.lit("")).when(F.col("p_partkey") % 10 == 1, F.lit('""'))
             .otherwise(F.col("p_partkey").cast("string")))
    lines = part.select(F.concat_ws(",", first, F.col("p_size").cast("string")).alias("line"))
    path = _write_lines(spark, lines, "accounted")
    loaded, counts = readers.load_lines(readers.read_lines(spark, path), "id BIGINT, size INT", scratch_path(spark, "loaded"))
    n = loaded.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("sizes"))
    return n.select(*[F.lit(counts[c]).cast("bigint").alias(c) for c in ("total", "loaded", "skipped")], "rows", "sizes")


def merged_states(spark, d):
    # A state of the years before 1998, stored; then the later rows as increments.
    li = table(spark, d, "lineitem").select("l_returnflag", "l_shipdate", "l_quantity")
    path = scratch_path(spark, "state")
    new_year = _ntz("1998-01-01 00:00:00")
    writers.write_table(agg.group_state(li.filter(F.col("l_shipdate") < new_year), "l_returnflag", "l_quantity"), path)
    increment = agg.group_state(li.filter(~F.coalesce(F.col("l_shipdate") < new_year, F.lit(False))), "l_returnflag", "l_quantity")
    return agg.state_stats(agg.merge_states("l_returnflag", spark.read.parquet(path), increment), "l_returnflag")


def partition_overwrite(spark, d):
    # Two runs that overlap by one type of event leave each event once.
    path = scratch_path(spark, "events_by_type")
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type")
    writers.write_partitions(ev.filter("event_type <= 'login'"), path, "event_type")
    writers.write_partitions(ev.filter("event_type >= 'login'"), path, "event_type")
    return spark.read.schema(ev.schema).parquet(path)


def job_parameters(spark, d):
    # A job started by its name, with an input path, an output path and a schema.
    path, out = scratch_path(spark, "employees"), scratch_path(spark, "salaries")
    staff = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("salary"),
                                               F.concat(F.lit("dept "), F.col("s_nationkey").cast("string")).alias("department"))
    writers.write_table(staff, path, "csv", header=True)
    launcher.main(["salary_by_department", path, out, "--schema", "id BIGINT, salary DOUBLE, department STRING"], stop=False)
    return spark.read.parquet(out).select("department", F.round("avg(salary)", 4).alias("avg_salary"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        local_rows, json_scan_nested, csv_scan_typed, csv_scan_multiline, parquet_roundtrip,
        csv_quoted_lines, load_accounting, json_lines_decode, project_topk, case_when_distinct,
        group_min_max, shift_between_bround, word_count, topn_zip_by_rank, null_defaults,
        na_drop_subset, leading_int, strip_newlines, top_entity_location_extremes, season_word_ranks,
        avg_null_as_zero, multi_format_years_since, prefix_filter_distinct, group_total_and_mode,
        distinct_count, date_string_filter, mode_month, global_extremes, group_avg_round,
        group_count_sorted, numeric_stats, top3_by_count, top3_weekdays_ru, join_inner_using,
        join_scaled_distinct, union_all_rows, join_global_avg, group_sum, join_broadcast_xor_count,
        cross_join_range, salted_join_band_avg, lookup_filter_basket, group_avg, csv_scan_inferred,
        csv_delimited_lines, json_roundtrip, csv_roundtrip, rename_drop, conform_schema,
        json_lines_defaults, global_avg_attached, join_prepartitioned, basket_per_group,
        global_extreme_records, salted_hot_key_join, csv_pipe_lines, weekday_from_epoch, join_distinct_sorted,
        repartition_round_robin, range_source_join, basket_result_roundtrip,
        csv_scan_multiline_split, full_rank_zip, top3_heavy_hitters, bitmap_distinct_counts, json_lines_strict,
        pruned_partition_basket, runtime_filter_join, bucketed_joins, load_accounting_written, merged_states,
        partition_overwrite, job_parameters,
    ]
}
