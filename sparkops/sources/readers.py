"""Readers: CSV (header, inferred or declared schema, multi-line cells), JSON
with a nested schema, raw text lines, delimited / JSON lines parsed into
typed columns, and small local tables.

Everything returns a lazy DataFrame. Declared schemas are preferred: schema
inference costs an extra pass over the input and its answer can change with
the data, so production jobs should pass ``schema``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkops.sources.writers import write_table

BAD_RECORD = "_bad_record"


def local_rows(spark: SparkSession, rows: Iterable[Sequence], names: Sequence[str],
               schema: T.StructType | str | None = None) -> DataFrame:
    """Small driver-side rows as a table with the given column names.

    Meant for lookup/code tables of a handful of rows, never for data.
    """
    df = spark.createDataFrame(list(rows), schema=schema)
    return df.toDF(*names)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             header: bool = True, multiline: bool = False, sep: str = ",",
             escape: str | None = None, empty_as_null: bool = True, max_columns: int = 1_000_000,
             **options: str) -> DataFrame:
    """CSV scan. With ``schema`` the data is read once; without it the types
    are inferred (an extra pass). Malformed cells become null (PERMISSIVE).

    ``multiline=True`` allows line breaks inside quoted cells; such files are
    not split (``read_csv_records`` reads them by many tasks). ``escape`` defaults to
    a doubled quote for multi-line files (RFC 4180) and to Spark's backslash
    otherwise. A quoted empty text reads as null, as in the original jobs,
    unless ``empty_as_null`` is off. ``max_columns`` sizes the parser's table of
    cells (Spark's default of 20,480 fails wider lines); lines of any width are
    read by ``read_lines`` and ``parse_csv_lines``.
    """
    reader = (spark.read.option("header", header).option("sep", sep).option("maxColumns", max_columns)
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if not empty_as_null:
        reader = reader.option("nullValue", "\u0000")  # stands for a cell with nothing in it
    if escape is None and multiline:
        escape = '"'
    if escape is not None:
        reader = reader.option("escape", escape)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(list(path) if not isinstance(path, str) else path)


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
              **options: str) -> DataFrame:
    """JSON-lines scan with a declared (possibly nested) schema."""
    reader = spark.read.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.json(list(path) if not isinstance(path, str) else path)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw text lines, one row each, column ``value``."""
    return spark.read.text(list(path) if not isinstance(path, str) else path)


def read_tagged(spark: SparkSession, paths: Mapping[str, str], tag: str = "tag",
                schema: T.StructType | str = "value STRING", header: bool = False, **options: str) -> DataFrame:
    """Several files or folders as ONE table with a ``tag`` column naming the
    input: one scan of all paths, the tag taken from each row's file path.

    Inputs are raw text lines (column ``value``), or CSV with a declared
    ``schema`` that all of them have. ``paths`` is tag -> file or folder.
    """
    where = {}
    for name, path in paths.items():
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at)
        where[at.toUri().getRawPath()] = name
    if schema == "value STRING":
        df = spark.read.text(list(paths.values()))
    else:
        df = read_csv(spark, list(paths.values()), schema=schema, header=header, **options)
    tags = F.create_map(*[F.lit(x) for pair in where.items() for x in pair])
    file = F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    folder = F.regexp_replace(file, "/[^/]*$", "")
    return df.withColumn(tag, F.coalesce(F.try_element_at(tags, file), F.try_element_at(tags, folder)))


def _ddl(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def _ddl_text(st: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in st.fields)


def _quoted(sep: str, escape: str) -> str:
    """Regex of a quoted cell up to the next separator. Possessive, so the matcher
    neither backtracks nor recurses, however long the line is."""
    e = re.escape(escape)
    inside = '[^"]*+(?:""[^"]*+)*+' if escape == '"' else f'(?:[^"{e}]|{e}.)*+'
    return f'"{inside}"(?={re.escape(sep)}|$)'


def _cell(sep: str, escape: str) -> str:
    """Regex of one cell: a quoted one, or what stands before the next separator."""
    c = re.escape(sep)
    other = f"[^{c}]*+" if len(sep) == 1 else f"(?:(?!{c}).)*+"
    return f"(?:{_quoted(sep, escape)}|{other})"


def first_cell(line: Column | str, sep: str = ",", escape: str = "\\") -> Column:
    """The first cell of a delimited line, without its quotes; the rest of the
    line isn't parsed, so it may have any number of cells."""
    line = F.col(line) if isinstance(line, str) else line
    quoted = F.regexp_extract(line, "(?s)^" + _quoted(sep, escape), 0)
    inner = F.replace(F.substring(quoted, 2, F.length(quoted) - 2), F.lit(escape + '"'), F.lit('"'))
    return F.when(quoted != "", inner).otherwise(F.substring_index(line, sep, 1))


def parse_csv_lines(lines: DataFrame, schema: T.StructType | str, sep: str = ",",
                    line_col: str = "value", header_value: str | None = None,
                    keep: Sequence[str] | None = None, escape: str = "\\",
                    keep_quotes: bool = False) -> DataFrame:
    """Delimited text lines -> typed columns, by position; a line may have any
    number of cells, of which those the schema names are parsed.

    Quoted cells may contain the separator (``a,"b, c",d`` has 3 cells); the
    quotes are removed. ``escape='"'`` reads doubled quotes inside a quoted
    cell as one quote (RFC 4180); the default escape is a backslash.
    ``keep_quotes=True`` splits only on separators outside quotes (those that an
    even number of quotes follows) and keeps the quote characters in the
    cells, as the original line splitter did.
    A cell that does not fit its type becomes null. With ``header_value``,
    lines whose first cell equals it (header lines) are dropped. ``keep``
    names extra input columns to carry along. ``sep`` is taken literally.
    """
    st = _ddl(schema)
    cols, line, width = list(keep or []), F.col(line_col), len(st.fields)
    if header_value is not None:
        first = F.substring_index(line, sep, 1) if keep_quotes else first_cell(line, sep, escape)
        lines = lines.filter(first.isNull() | (first != header_value))
    if keep_quotes:
        # Of an odd number of quotes the first has none to go with it, and all
        # before it counts as inside.
        odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
        c = re.escape(sep)
        outside = f'[^"{c}]' if len(sep) == 1 else f'(?!{c})[^"]'
        rest = f'(?:{outside}|"[^"]*+")*+)(?:{c}|$)'
        found = F.when(odd, F.regexp_extract_all(line, F.lit('(?s)((?:^[^"]*+")?+' + rest), 1)).otherwise(
            F.regexp_extract_all(line, F.lit("(?s)(" + rest), 1))
        return (lines.select(*cols, F.slice(found, 1, width).alias("_c"))
                .select(*cols, *[_typed(F.get(F.col("_c"), i), f.dataType).alias(f.name)
                                 for i, f in enumerate(st.fields)]))
    cell = _cell(sep, escape)
    head = F.regexp_extract(line, f"(?s)^{cell}(?:{re.escape(sep)}{cell}){{0,{width - 1}}}+", 0)
    parsed = F.from_csv(F.when(line.isNotNull(), head), _ddl_text(st),
                        {"sep": sep, "mode": "PERMISSIVE", "escape": escape})
    return lines.select(*cols, parsed.alias("_r")).select(*cols, "_r.*")


def _typed(cell: Column, dtype: T.DataType) -> Column:
    """A text cell as ``dtype``: empty -> null, values that do not fit -> null."""
    from sparkops.operators.shape import _cast
    cell = F.when(cell != "", cell)
    return cell if isinstance(dtype, T.StringType) else _cast(cell, T.StringType(), dtype)


def load_accounting(lines: DataFrame, line_col: str = "value", sep: str = ",", escape: str = "\\") -> DataFrame:
    """One row: total lines, loaded lines (first cell non-empty), skipped.

    One scan, one aggregation: a header whose first cell is empty counts as
    skipped, like any other line without an id. A quoted first cell is read
    as the parser reads it, so ``""`` is empty.
    """
    first = first_cell(line_col, sep, escape)
    return (lines.agg(F.count(F.lit(1)).alias("total"),
                      F.count_if(first != "").alias("loaded"))
            .withColumn("skipped", F.col("total") - F.col("loaded")))


def load_lines(lines: DataFrame, schema: T.StructType | str, path: str, sep: str = ",", line_col: str = "value",
               escape: str = "\\", fmt: str = "parquet") -> tuple[DataFrame, dict[str, int]]:
    """Parse delimited lines, write those with a non-empty first cell under ``path``,
    and count on the way: the table read back, and its accounting (total, loaded,
    skipped), without a second scan.

    The counts are observed by the job that writes. It has one stage, from the scan
    to the files, so a lost or repeated task counts once.
    """
    first = first_cell(line_col, sep, escape)
    seen = Observation()
    counted = lines.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(first != "").alias("loaded"))
    loaded = parse_csv_lines(counted.filter(first != ""), schema, sep, line_col, escape=escape)
    write_table(loaded, path, fmt)
    counts = {"total": 0, "loaded": 0, **seen.get}
    counts["skipped"] = counts["total"] - counts["loaded"]
    return lines.sparkSession.read.schema(loaded.schema).format(fmt).load(path), counts


def decode_json_lines(lines: DataFrame, schema: T.StructType | str, line_col: str = "value",
                      defaults: Mapping[str, object] | None = None,
                      keep: Sequence[str] | None = None) -> DataFrame:
    """JSON text lines -> typed columns; undecodable lines are dropped.

    A line is rejected when it is not JSON or a value does not fit its
    declared type. Missing fields stay null unless ``defaults`` gives a value.
    """
    st = _ddl(schema)
    with_bad = T.StructType(list(st.fields) + [T.StructField(BAD_RECORD, T.StringType())])
    parsed = F.from_json(F.col(line_col), with_bad,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD})
    # Parse once per line: a filter on the parsed struct would be pushed
    # below the projection and re-run the parser for every referenced field.
    # Instead the struct goes through a 0-or-1 element generator.
    accepted = F.filter(F.array(parsed), lambda r: r.isNotNull() & r.getField(BAD_RECORD).isNull())
    out = (lines.select(*(keep or []), F.inline(accepted))
           .select(*(keep or []), *[F.col(f.name) for f in st.fields]))
    if defaults:
        out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})
    return out


_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _strict_field(value: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """A variant as ``dtype``, and whether it may stand there: missing and null may."""
    name, kind = dtype.simpleString(), F.schema_of_variant(value)
    missing = value.isNull() | (kind == "VOID")
    typed = F.when(~missing, F.try_variant_get(value, "$", name))
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    if name == "string":
        fits = kind == "STRING"
    elif name in _WHOLE:  # 5.0 is a whole number, 5.5 is none
        fits = (kind == "BIGINT") | (number & (typed.cast("double") == F.try_variant_get(value, "$", "double")))
    elif name in ("double", "float") or isinstance(dtype, T.DecimalType):
        fits = number
    elif name == "boolean":
        fits = kind == "BOOLEAN"
    else:
        fits = F.lit(True)
    return typed, missing | F.coalesce(fits & typed.isNotNull(), F.lit(False))


def decode_json_strict(lines: DataFrame, schema: T.StructType | str, line_col: str = "value",
                       defaults: Mapping[str, object] | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """JSON text lines -> typed columns, with no conversion between JSON types: a
    number in a text field, text in a number field, a fraction or an overflow in a
    whole-number field rejects the record, as do lines that hold no JSON object.
    Missing and null fields are null, or their value in ``defaults``. (``decode_json_lines``
    takes the number as text.) Lines are parsed once, to variants.

    Nested fields (structs, arrays, maps) must convert as a whole. Field names are
    taken literally, case included; an object that repeats a key is rejected.
    """
    st, carried = _ddl(schema), list(keep or [])
    parsed = F.try_parse_json(F.col(line_col))
    # A generator of none or one, so that no later expression runs the parser again.
    some = lines.select(*carried, F.explode(F.filter(F.array(parsed), lambda v: F.schema_of_variant(v).startswith("OBJECT"))).alias("_v"))
    fields = some.select(*carried, *[F.try_variant_get("_v", f"$[{_path_name(f.name)}]", "variant").alias(f"_f{i}")
                                     for i, f in enumerate(st.fields)])
    made = [_strict_field(F.col(f"_f{i}"), f.dataType) for i, f in enumerate(st.fields)]
    out = fields.filter(reduce(lambda a, b: a & b, [ok for _, ok in made])) if made else fields
    default = defaults or {}
    return out.select(*carried, *[F.coalesce(c, F.lit(default[f.name])).alias(f.name) if f.name in default else c.alias(f.name)
                                  for (c, _), f in zip(made, st.fields, strict=True)])


def _path_name(name: str) -> str:
    quote = '"' if "'" in name else "'"
    return quote + name + quote
