"""Writers. All overwrite: re-running a job (or a retried stage) replaces its
output instead of appending duplicates."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from sparkops._cols import as_list


def write_table(df: DataFrame, path: str, fmt: str = "parquet", header: bool = False,
                mode: str = "overwrite", **options: str) -> str:
    """Write ``df`` as parquet / json / csv / text under ``path``; returns path.

    CSV is written without header unless asked (the pizza job's output).
    Blanks at the ends of a text are kept (Spark's own default trims them);
    empty text is written as ``""`` and null as nothing, which
    ``read_csv(..., empty_as_null=False)`` tells apart again.
    """
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = (writer.option("header", header).option("ignoreLeadingWhiteSpace", False)
                  .option("ignoreTrailingWhiteSpace", False).option("emptyValue", '""'))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)
    return path


def write_partitions(df: DataFrame, path: str, by: str | Sequence[str], fmt: str = "parquet",
                     replace: str = "touched", **options: str) -> str:
    """Write ``df`` under ``path``, one folder for each value of ``by``; returns path.

    ``replace="touched"`` replaces only the folders that ``df`` has rows for, so a
    run that is repeated, or overlaps an earlier one by some days, leaves each row
    once; ``"all"`` replaces the whole table. Rows are dealt by ``by`` first, so that a
    folder gets few files; adaptive execution cuts a folder that holds much of the
    rows into several.
    """
    if replace not in ("touched", "all"):
        raise ValueError("replace must be 'touched' or 'all'")
    keys = as_list(by)
    writer = (df.hint("rebalance", *keys).write.mode("overwrite").format(fmt).partitionBy(*keys)
              .option("partitionOverwriteMode", "dynamic" if replace == "touched" else "static"))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)
    return path


def write_bucketed(df: DataFrame, path: str, by: str | Sequence[str], buckets: int, name: str | None = None) -> DataFrame:
    """Store ``df`` as a table of ``buckets`` buckets by the columns ``by``, each sorted
    and in one file, and read it back. Joins and aggregations by these columns of
    tables of as many buckets need no shuffle, however often they run.

    The files lie under ``path``; the table is known to the session's catalog as
    ``name`` (a fresh one by default).
    """
    keys, name = as_list(by), name or f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)
