"""Result comparison against the DuckDB oracles (used by tests and by
``python -m sparkops.plans.compare``). Test tooling: it collects small
results on purpose."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _rows(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
               "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
               "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _duck_type(spark_type: str) -> str:
    return _DUCK_TYPES.get(spark_type, spark_type.upper())


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from sparkops.plans.oracle import ORACLE_SQL
    from sparkops.plans.queries import QUERIES
    con = con or duckdb_conn(sf_dir)
    sdf = QUERIES[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ORACLE_SQL[name])
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, (str(t) for t in rel.types)))
    d_rows = rel.fetchall()
    res = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    s_types = {f.name: _duck_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    res["types_match"] = all(s_types.get(c) == d_types.get(c) for c in d_cols)
    if not res["types_match"]:
        res["types"] = {c: (s_types.get(c), d_types.get(c)) for c in d_cols if s_types.get(c) != d_types.get(c)}
    res["exact"] = res["cols_match"] and _rows(s_cols, s_rows, None) == _rows(d_cols, d_rows, None)
    res["approx"] = res["cols_match"] and _rows(s_cols, s_rows, 9) == _rows(d_cols, d_rows, 9)
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    return res


def main(argv):
    from sparkops.plans.queries import QUERIES
    from sparkops.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_conn(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:400]}
        ok = r.get("exact") and r.get("types_match")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} exact")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
