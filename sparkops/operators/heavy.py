"""Most frequent keys without a shuffle of all keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkops.operators.aggregate import count_by, top_groups
from sparkops.session import scratch_path

_SKETCHED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType,
             T.TimestampType, T.TimestampNTZType, T.StringType, T.DecimalType)


def error_share(tracked: int) -> float:
    """The share of all rows that a summary of ``tracked`` keys may be wrong by, for any key:
    3.5 over its table's size, the power of two of which three quarters hold ``tracked``."""
    size = 1
    while 0.75 * size < tracked:
        size *= 2
    return 3.5 / size


def heavy_groups(df: DataFrame, key: str, k: int, name: str = "count", tracked: int = 10_000,
                 candidates: int | None = None) -> DataFrame:
    """The ``k`` most frequent keys with their counts, ties by key (a null key loses
    ties): what ``top_groups`` returns, for columns of very many different keys.

    Each task sums up its rows in a mergeable summary of frequent items (Misra-Gries,
    ``tracked`` keys at most), so what is shuffled follows the summaries and not the
    keys. The merged summary names ``candidates`` keys, which are then counted exactly.
    The result is proven, or else not used: no other key can have more rows than
    the summary's error allows, twice ``error_share(tracked)`` of all, or than the
    least of the named ones was estimated at. If the k-th count is over that, or if the
    candidates hold all rows, nothing was missed. Otherwise (no key is frequent) all
    keys are counted. The exact counts of the candidates are stored in the shared
    scratch folder. Keys that a summary can't hold (structs, arrays) are counted in full.
    """
    candidates = max(100, 10 * k) if candidates is None else candidates
    if not k <= candidates <= tracked:
        raise ValueError("k <= candidates <= tracked must hold")
    if not isinstance(df.schema[key].dataType, _SKETCHED):
        return top_groups(df, key, k, name)
    top = F.call_function("approx_top_k", F.col(key), F.lit(candidates), F.lit(tracked))
    found = df.agg(F.count(F.lit(1)).alias("n"), top.alias("top"))
    path = scratch_path(df.sparkSession, "heavy")
    found.write.parquet(path)
    found = df.sparkSession.read.parquet(path)  # one row
    named = found.select(F.explode("top").alias("t")).select(F.col("t.item").alias("_key"))
    exact = df.join(F.broadcast(named), F.col(key).eqNullSafe(F.col("_key")), "left_semi")  # at most ``candidates`` rows
    path = scratch_path(df.sparkSession, "heavy-counts")
    count_by(exact, key, name).write.parquet(path)
    exact = df.sparkSession.read.parquet(path)
    bound = found.select("n", F.size("top").alias("named"), F.array_min(F.transform("top", lambda t: t["count"])).alias("least")).first()
    held = exact.agg(F.sum(name).alias("held")).first().held or 0
    best = exact.orderBy(F.desc(name), F.asc_nulls_last(key)).limit(k)
    kth = best.agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("least")).first()
    others = max(2 * error_share(tracked) * bound.n, bound.least if bound.named >= candidates else 0)
    if held == bound.n or (kth.n == k and kth.least > others):
        return best
    return top_groups(df, key, k, name)
