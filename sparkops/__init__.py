"""sparkops: batch data operators and ready-made jobs built on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function made of native Spark expressions, so Catalyst plans the whole job:
filters reach the scan, aggregations combine map-side, and nothing is
gathered on the driver.

Layout:
    sources/    readers (CSV, JSON, text lines, local rows) and writers
    functions/  column-level helpers (text, dates, numbers)
    operators/  DataFrame-level operators (shaping, aggregation, ranking, joins)
    plans/      registered queries, their DuckDB oracles, plan inspection
    jobs/       the end-to-end jobs, one function each
"""

__version__ = "0.1.0"
