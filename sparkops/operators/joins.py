"""Joins: one-key lookups, XOR mismatch counting,
row replication, salted skew joins and the band join with averages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkops._cols import as_list as _list


def lookup_key(dim: DataFrame, name_col: str, name: str, key_col: str, alias: str | None = None) -> DataFrame:
    """The key of the dimension row named ``name``, as a one-row table
    (smallest key if several share the name; null if none)."""
    return (dim.filter(F.col(name_col) == name)
            .agg(F.min(key_col).alias(alias or key_col)))


def lookup_filter(fact: DataFrame, dim: DataFrame, dim_pred: Column, on: Column) -> DataFrame:
    """Rows of ``fact`` that have a partner among the ``dim`` rows passing
    ``dim_pred`` (a left-semi join: ``fact`` rows are never duplicated). The
    planner decides how, with AQE's runtime sizes."""
    return fact.join(dim.filter(dim_pred), on, "left_semi")


def xor_mismatches(left: DataFrame, codes: DataFrame, cond: Column, p: Column, q: Column,
                   name: str = "errors") -> DataFrame:
    """Count joined rows where exactly one of two predicates holds.

    Rows where either predicate is null are not counted. A ``codes`` table of
    known small size is broadcast by the caller (``F.broadcast``).
    """
    return left.join(codes, cond).filter(p != q).agg(F.count(F.lit(1)).alias(name))


def replicate(df: DataFrame, n: int, salt_col: str = "salt") -> DataFrame:
    """Every row ``n`` times, tagged ``salt_col`` = 0 .. n-1 (no cross join)."""
    return df.withColumn(salt_col, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))


def salt(df: DataFrame, n: int, by: str | Sequence[str], salt_col: str = "salt") -> DataFrame:
    """Tag each row with ``pmod(xxhash64(by), n)``.

    The salt is a function of the row, not a random number, so a retried
    task puts every row in the same place again.
    """
    return df.withColumn(salt_col, F.pmod(F.xxhash64(*[F.col(c) for c in _list(by)]), F.lit(n)).cast("bigint"))


def hot_keys(df: DataFrame, keys: str | Sequence[str], share: float | None = None,
             copies: str = "_copies", most_copies: int | None = None) -> DataFrame:
    """Keys that hold at least ``share`` of the rows of ``df`` (null keys aside),
    with the number of pieces that brings each down to that share.

    At most ``1 / share`` keys can qualify, so the result has a bounded size and
    may be broadcast. ``share`` defaults to one shuffle partition's fair part, so
    both follow the session's partitioning. One partial aggregation over the
    keys serves the counts and their total (one shared exchange).
    """
    ks = _list(keys)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = 1.0 / n if share is None else share
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    some = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ks])
    counts = df.filter(some).groupBy(*ks).agg(F.count(F.lit(1)).alias("_c"))
    part = counts.agg(F.sum("_c")).scalar() * F.lit(share)
    pieces = F.least(F.ceil(F.col("_c") / part), F.lit(most_copies or n))
    return counts.filter(F.col("_c") >= part).select(*ks, F.greatest(pieces, F.lit(1)).cast("bigint").alias(copies))


def salted_join(big: DataFrame, small: DataFrame, keys: str | Sequence[str],
                row_key: str | Sequence[str], n: int | None = None, how: str = "inner",
                salt_col: str = "_salt", hot_share: float | None = None,
                residual: Column | None = None, hot: DataFrame | None = None,
                hot_on: str | Sequence[str] | None = None) -> DataFrame:
    """Equi-join on ``keys`` that survives a hot key.

    Only keys holding at least ``hot_share`` of ``big`` are salted (found by
    :func:`hot_keys`; by default those above a shuffle partition's fair part):
    a hash of ``row_key`` deals their rows of ``big`` over as many salts as the
    key needs, and their rows of ``small`` are copied to each. Every other
    key joins unsalted, so the copies follow the skew. ``hot`` gives the hot
    keys found beforehand, by the columns ``hot_on`` (part of ``keys``).
    With ``n`` every key is spread over ``n`` salts, and ``hot_share`` or ``hot``
    then bound the number of salts instead. The result equals the plain join
    on ``keys`` in all cases (null keys never match). ``residual`` is an extra
    condition on the joined row (e.g. a band test). Inner, left, left-semi and
    left-anti joins are supported; right and full joins are not, since
    unmatched rows of the copied side would come out once per salt.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "left_anti"):
        raise ValueError(f"salted_join supports inner/left/semi/anti joins, not {how!r}")
    if residual is not None and how != "inner":
        raise ValueError("a residual condition is only exact for inner joins")
    ks = _list(keys)
    if n is not None and hot_share is None and hot is None:
        joined = (salt(big, n, row_key, salt_col)
                  .join(replicate(small, n, salt_col), ks + [salt_col], how)
                  .drop(salt_col))
        return joined if residual is None else joined.filter(residual)
    by = _list(hot_on) if hot_on is not None else ks
    hot = F.broadcast(hot if hot is not None else hot_keys(big, by, hot_share, most_copies=n))
    copies = F.coalesce(F.col("_copies"), F.lit(1).cast("bigint"))
    big_s = (big.join(hot, by, "left")
             .withColumn(salt_col, F.pmod(F.xxhash64(*[F.col(c) for c in _list(row_key)]), copies)).drop("_copies"))
    small_s = (small.join(hot, by, "left")
               .withColumn(salt_col, F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))).drop("_copies"))
    joined = big_s.join(small_s, ks + [salt_col], how).drop(salt_col)
    return joined if residual is None else joined.filter(residual)


def band_avg_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
                  left_level: str, right_level: str, left_id: str, value: str,
                  band: float = 1, salt_n: int | None = None, id_name: str = "id",
                  avg_name: str = "avg", hot_share: float | None = None) -> DataFrame:
    """For every ``left_id``: average ``value`` over all (left, right) row
    pairs with equal ``keys`` and ``|left_level - right_level| <= band``.

    Equivalent to joining the two tables and averaging per id, but the pairs
    are never built: ``right`` is first reduced to (keys, level) -> (sum,
    count), the band becomes an equi-join on level buckets of width
    ``band`` (neighbouring buckets included, exact test as residual), and
    the left rows of hot keys are dealt by id over salts, each with a copy of
    the reduced right side (see :func:`salted_join`; hot keys are found before
    the left rows are spread over buckets). ``salt_n`` = 1 turns salting off,
    a larger one without ``hot_share`` salts every key.
    Ids without any partner are absent; ids whose partners all have null
    values get a null average.
    """
    ks = _list(keys)
    width = float(band) if band > 0 else 1.0
    r = (right.select(*ks, F.col(right_level).alias("_rl"), F.col(value).alias("_v"))
         .groupBy(*ks, "_rl")
         .agg(F.sum("_v").alias("_s"), F.count("_v").alias("_n"))
         .withColumn("_b", F.floor(F.col("_rl") / F.lit(width))))
    lb = F.floor(F.col("_ll") / F.lit(width))
    spread = F.sequence(lb - 1, lb + 1) if band > 0 else F.array(lb)
    lft = (left.select(F.col(left_id).alias("_id"), *ks, F.col(left_level).alias("_ll"))
           .withColumn("_b", F.explode(spread)))
    in_band = F.abs(F.col("_ll") - F.col("_rl")) <= F.lit(band)
    if salt_n == 1:
        matched = lft.join(r, ks + ["_b"]).filter(in_band)
    elif salt_n is not None and hot_share is None:
        matched = salted_join(lft, r, ks + ["_b"], "_id", salt_n, residual=in_band)
    else:
        hot = hot_keys(left, ks, hot_share, most_copies=salt_n)
        matched = salted_join(lft, r, ks + ["_b"], "_id", residual=in_band, hot=hot, hot_on=ks)
    return (matched.groupBy("_id")
            .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
            .select(F.col("_id").alias(id_name),
                    F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).alias(avg_name)))
