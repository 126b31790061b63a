"""CSV files with line breaks inside quoted cells, read by as many tasks as they
have splits.

Where a split starts, nothing tells whether it starts inside a quoted cell; that
depends on the number of quotes before it. So every split counts its quotes, an
exclusive xor over the (small) table of a file's splits tells how each starts, and
a running count inside the split then tells for every line. A line that starts
outside of quotes starts a record. A record that goes on into the next split, or
over several, is put together from its pieces; there are at most two a split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkops.sources.readers import _ddl, _ddl_text

_SPLIT = ["_file", "_block"]


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their place: file, start of the split, number inside the task."""
    return (spark.read.option("lineSep", "\n").text(list(path) if not isinstance(path, str) else path)
            .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                    F.monotonically_increasing_id().alias("_seq"), F.col("value").alias("_line")))


def _quotes() -> Column:
    return F.length("_line") - F.length(F.replace(F.col("_line"), F.lit('"'), F.lit("")))


def _text(order: str, piece: str) -> Column:
    """Lines or pieces, in order, as one text."""
    some = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(piece))))
    return F.array_join(F.transform(some, lambda x: x.getField(piece)), "\n")


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The records of CSV files as text: ``record``, and ``is_first`` for the first of
    each file. Empty lines outside of quotes are no records.

    The lines are scanned once and dealt out by split; both the table of the splits
    and the records are made from that one exchange, so the splits are the same for
    both. A file whose first line ends with ``\\r\\n`` has that as its line end, also inside
    cells, where it comes out as ``\\n``; in others it stays as it is.
    """
    lines = _lines(spark, path).repartition(*_SPLIT)
    odd = _quotes() % 2
    splits = lines.groupBy(*_SPLIT).agg((F.sum(odd) % 2).alias("_odd"), F.max("_seq").alias("_last"),
                                        F.min(F.when(odd == 1, F.col("_seq"))).alias("_turn"),
                                        F.min_by(F.endswith("_line", F.lit("\r")), "_seq").alias("_crlf"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_open", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2)
    # A split that starts inside quotes has a line start outside of them if quotes close before its last line.
    starts = (F.col("_open") == 0) | (F.col("_turn") < F.col("_last"))
    splits = splits.withColumn("_owner", F.last(F.when(starts, F.col("_block")), ignorenulls=True).over(earlier))
    so_far = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    splits = splits.withColumn("_crlf", F.first("_crlf").over(so_far))
    splits = splits.withColumn("_ends_open", (F.col("_open") + F.col("_odd")) % 2 == 1).drop("_odd", "_turn")

    placed = lines.join(splits, _SPLIT)
    inside = Window.partitionBy(*_SPLIT).orderBy("_seq")
    before = F.coalesce(F.sum(odd).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("_start", ((F.col("_open") + before) % 2 == 0).cast("int"))
    placed = placed.withColumn("_rec", F.sum("_start").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = placed.groupBy(*_SPLIT, "_rec", "_owner", "_last", "_ends_open", "_crlf").agg(
        _text("_seq", "_line").alias("_piece"), F.max("_seq").alias("_end"))
    head = F.col("_rec") == 0
    tail = (F.col("_end") == F.col("_last")) & F.col("_ends_open")
    first = (F.col("_block") == 0) & (F.col("_rec") == 1)
    whole = pieces.where(~head & ~tail).select(F.col("_piece").alias("record"), first.alias("is_first"), "_crlf")
    # A head goes to the record left open by the last split before it that started one.
    cut = pieces.where(head | tail).withColumn("_owner", F.when(head, F.col("_owner")).otherwise(F.col("_block")))
    mended = cut.groupBy("_file", "_owner", "_crlf").agg(_text("_block", "_piece").alias("record"), F.max(first).alias("is_first"))
    every = whole.unionByName(mended.select("record", "is_first", "_crlf"))
    text = F.col("record")
    body = F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)
    text = F.when(F.col("_crlf"), F.replace(body, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    return every.select(text.alias("record"), "is_first").where("record <> ''")


def read_csv_records(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, header: bool = True,
                     sep: str = ",", empty_as_null: bool = True, max_columns: int = 1_000_000) -> DataFrame:
    """CSV scan with line breaks inside quoted cells, split over many tasks: the rows
    that ``read_csv(..., multiline=True)`` gives, for files of any size.

    Quotes inside a quoted cell are doubled (RFC 4180), and a cell that isn't quoted
    holds none: a lone quote would be taken to open a cell, up to the next one. The
    types are declared; cells that don't fit become null. With ``header`` the first
    record of each file is dropped.
    """
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "maxColumns": str(max_columns)}
    if not empty_as_null:
        options["nullValue"] = "\u0000"  # stands for a cell with nothing in it
    records = csv_records(spark, path)
    if header:
        records = records.where(~F.col("is_first"))
    bare = F.regexp_replace("record", "^\ufeff", "")  # a byte order mark
    text = F.when(F.col("is_first"), bare).otherwise(F.col("record"))
    return records.select(F.from_csv(text, _ddl_text(_ddl(schema)), options).alias("_r")).select("_r.*")
