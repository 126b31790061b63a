"""Readers and writers."""

from sparkops.sources.readers import (  # noqa: F401
    decode_json_lines, decode_json_strict, first_cell, load_accounting, load_lines, local_rows, parse_csv_lines,
    read_csv, read_json, read_lines, read_tagged,
)
from sparkops.sources.records import csv_records, read_csv_records  # noqa: F401
from sparkops.sources.writers import write_bucketed, write_partitions, write_table  # noqa: F401
