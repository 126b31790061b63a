"""Run a job from the command line, the way the original programs were run
with ``main(args)``:

    python -m sparkops.jobs pizza <orders.csv> <out_dir>
    python -m sparkops.jobs access_log <logs.csv> <out_dir>
    python -m sparkops.jobs basket <transactions.csv> <country_codes.csv> <out_dir>

An extra last argument is the output folder: jobs with their own output
format (pizza: CSV, movies / mall_income / basket: parquet) write it
themselves, the others are written as parquet (a job with several results
writes one sub-folder each). Without an output folder the result is
printed. The master comes from spark-submit (or --master).

``--schema`` gives the columns of an input file (DDL, in file order; once per
input), so that no pass is spent on inferring them. ``--input-bytes`` and
``--total-cores`` size the session to the data; without them the settings of
spark-submit stay. ``season_word_ranks`` takes the two subtitle files.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from sparkops import jobs
from sparkops.session import get_session
from sparkops.sources.writers import write_table

# job name -> number of input paths it takes
INPUTS = {
    "restaurants": 1, "movies": 1, "bike_projection": 1, "bike_workday": 1, "bike_min_max": 1,
    "mall_income": 1, "shoes": 1, "job_reviews": 1, "cars": 1, "positions": 1, "pizza": 1,
    "avocado": 1, "access_log": 1, "products": 1, "salary_by_department": 1,
    "season_word_ranks": 2, "freelancer_offers": 2, "hotel_cancellations": 2, "basket": 2,
}


def main(argv: list[str], stop: bool = True) -> int:
    ap = argparse.ArgumentParser(prog="python -m sparkops.jobs")
    ap.add_argument("job", choices=sorted(INPUTS))
    ap.add_argument("paths", nargs="+", help="input path(s), then optionally the output folder")
    ap.add_argument("--master", default=None)
    ap.add_argument("--schema", action="append", default=[], help="DDL of an input, once per input")
    ap.add_argument("--input-bytes", type=int)
    ap.add_argument("--total-cores", type=int)
    args = ap.parse_args(argv)
    n_in = INPUTS[args.job]
    if len(args.paths) not in (n_in, n_in + 1):
        ap.error(f"{args.job} takes {n_in} input path(s) and an optional output folder")
    inputs, out = args.paths[:n_in], (args.paths[n_in] if len(args.paths) > n_in else None)
    if (args.input_bytes is None) != (args.total_cores is None):
        ap.error("--input-bytes and --total-cores go together")
    fn = getattr(jobs, args.job)
    takes = inspect.signature(fn).parameters
    options = {}
    if args.schema:
        if len(args.schema) != n_in or not {"schema", "schemas"} & set(takes):
            ap.error(f"{args.job} takes {n_in if {'schema', 'schemas'} & set(takes) else 'no'} --schema")
        options = {"schema": args.schema[0]} if "schema" in takes else {"schemas": tuple(args.schema)}
    spark = get_session(args.master, app_name=f"sparkops-{args.job}", input_bytes=args.input_bytes,
                        total_cores=args.total_cores)
    if args.job == "season_word_ranks":
        inputs = [dict(zip(("s1", "s2"), inputs, strict=True))]
    if out and "out_path" in takes:
        fn(spark, *inputs, out_path=out, **options)  # the job writes its own format
        if stop:
            spark.stop()
        return 0
    result = fn(spark, *inputs, **options)
    results = result if isinstance(result, dict) else {"": result}
    for name, df in results.items():
        if out:
            write_table(df, f"{out.rstrip('/')}/{name}" if name else out)
        else:
            if name:
                print(f"== {name}")
            df.show(truncate=False)
    if stop:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
