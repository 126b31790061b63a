"""Benchmark: run every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line with per-query wall seconds.

Each query is executed in full through the ``noop`` sink (all rows computed,
nothing collected on the driver). A first (cold) pass over all queries
includes one-time JVM costs -- class loading, code generation, JIT -- that
do not grow with the data; it is reported as ``cold_value``. Then each query
runs twice more and the faster run is its steady-state time; their sum is
the reported ``value``.

Set ``BENCH_EVENT_LOG`` to a fresh folder to get Spark's event log (stage
and task times) there; ``BENCH_QUERIES`` (comma list) limits the queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sparkops.jobs import join_layouts  # noqa: E402
from sparkops.plans.inspect import exchange_count  # noqa: E402
from sparkops.plans.queries import QUERIES  # noqa: E402
from sparkops.session import get_session  # noqa: E402


def shuffle_study(spark) -> dict[str, dict]:
    """The reference's join study at its own size (500,000 x 10,000 rows of
    (id, salary), auto-broadcast off): seconds and exchange count per layout,
    """
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df1 = spark.range(1, 500001).select(F.col("id").cast("int").alias("id"),
                                            (F.col("id") * 100).cast("int").alias("salary"))
        df2 = spark.range(1, 10001).select(F.col("id").cast("int").alias("id"),
                                           (F.col("id") * 1000).cast("int").alias("salary"))
        out = {}
        for name, df in join_layouts(df1, df2).items():
            df.write.format("noop").mode("overwrite").save()  # warm
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            out[name] = {"sec": round(time.perf_counter() - t0, 3), "exchanges": exchange_count(df)}
        return out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sparkops-bench-")}
    event_log = os.environ.get("BENCH_EVENT_LOG")  # a fresh folder for stage/task times
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="sparkops-bench",
                        extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in QUERIES if not only or n in only]

    def run_once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    cold = {name: run_once(name) for name in names}
    # Steady state: the best of two back-to-back runs of each query (the
    # shared machine's timing noise only ever adds time).
    warm = {name: min(run_once(name), run_once(name)) for name in names}
    study = shuffle_study(spark) if not only else {}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds_warm", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "cold_value": round(sum(cold.values()), 3),
                      "cold_queries": cold, "shuffle_study": study, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
