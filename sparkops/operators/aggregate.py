"""Aggregations. Every one combines map-side (partial aggregation) before
its shuffle, so a hot key costs one partial row per task, not a hot task.
Ties are always broken by the smaller key, so results are deterministic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkops._cols import as_list as _list
from sparkops.functions.numeric import int_avg


def count_by(df: DataFrame, keys: str | Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key (null keys form their own group)."""
    return df.groupBy(*_list(keys)).agg(F.count(F.lit(1)).alias(name))


def top_groups(df: DataFrame, keys: str | Sequence[str], k: int, name: str = "count") -> DataFrame:
    """The ``k`` most frequent keys with their counts, ties by key (a null
    key loses ties).

    Planned as aggregate + TakeOrderedAndProject: every task keeps its own
    top ``k`` and only those reach the final merge.
    """
    ks = _list(keys)
    return count_by(df, ks, name).orderBy(F.desc(name), *[F.asc_nulls_last(c) for c in ks]).limit(k)


def mode(df: DataFrame, col: str, name: str | None = None, count_name: str | None = None,
         by: str | Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value of ``col`` (ties -> smallest value).

    Without ``by``: one row. With ``by``: one row per group, found with an
    ordered aggregate (see ``_Argmax``), so no group is ever sorted whole.
    """
    gs = _list(by)
    nonnull = df.filter(F.col(col).isNotNull())
    if not gs:
        out = top_groups(nonnull, col, 1, name="_n")
        cols = [F.col(col).alias(name or col)]
        if count_name:
            cols.append(F.col("_n").alias(count_name))
        return out.select(*cols)
    pairs = count_by(nonnull, gs + [col], "_n")
    best = _Argmax(pairs, "_n", col)
    out = pairs.groupBy(*gs).agg(best.agg.alias("_m"))
    cols = [*gs, best.key(F.col("_m")).alias(name or col)]
    if count_name:
        cols.append(best.count(F.col("_m")).alias(count_name))
    return out.select(*cols)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_D38 = "decimal(38,0)"


def _shift() -> Column:
    return F.lit(str(10 ** 20)).cast(_D38)


def _top() -> Column:
    return F.lit(str(2 ** 63)).cast(_D38)


class _Argmax:
    """The key with the largest count per group; ties -> smallest key.

    ``null_key="last"``: a null key competes but loses ties (SQL's
    ``ORDER BY count DESC, key`` with nulls last); ``"never"``: a null key
    only comes out when there is no other. Counts must be non-negative.

    For an integral key the whole ordering is packed into one
    ``decimal(38,0)`` -- count * 10^20 + (2^63 - key) -- whose plain ``max``
    runs in a hash aggregate with code generation. Other keys use an
    ordered ``min(struct)``, which Spark runs as a sort aggregate. Both
    combine map-side.
    """

    def __init__(self, df: DataFrame, count_col: str, key_col: str, null_key: str = "last"):
        n, k = F.col(count_col), F.col(key_col)
        kt = df.schema[key_col].dataType
        # packing needs whole, non-negative counts and an integral key
        self.packed = isinstance(kt, _INTEGRAL) and isinstance(df.schema[count_col].dataType, _INTEGRAL)
        self.key_type = kt
        if self.packed:
            rank = _top() - k.cast(_D38)
            if null_key == "last":
                rank = F.coalesce(rank, F.lit(0).cast(_D38))
            self.agg = F.max(n.cast(_D38) * _shift() + rank)
        else:
            first = [k.isNull().alias("kn")] if null_key == "never" else []
            last = [] if null_key == "never" else [k.isNull().alias("kn")]
            self.agg = F.min(F.struct(*first, n.isNull().alias("z"), (-n).alias("neg"), *last,
                                      k.alias("key")))

    def key(self, m: Column) -> Column:
        if self.packed:
            r = m % _shift()
            return F.when(r != 0, (_top() - r).cast(self.key_type))
        return m.getField("key")

    def count(self, m: Column) -> Column:
        if self.packed:
            return F.call_function("div", m, _shift()).cast("bigint")
        return -m.getField("neg")


def total_and_mode(df: DataFrame, by: str, col: str, total_name: str = "total",
                   value_name: str | None = None, count_name: str = "count") -> DataFrame:
    """Per ``by`` group: number of rows, its most frequent ``col`` value and
    that value's count (ties -> smallest value; a null value competes but
    loses ties).

    Two partial aggregations -- by (by, col), then by ``by`` -- and never a
    whole group in memory.
    """
    pairs = count_by(df, [by, col], "_n")
    best = _Argmax(pairs, "_n", col)
    return (pairs.groupBy(by)
            .agg(F.sum("_n").alias(total_name), best.agg.alias("_m"))
            .select(by, total_name, best.key(F.col("_m")).alias(value_name or col),
                    best.count(F.col("_m")).alias(count_name)))


def numeric_stats(df: DataFrame, col: str, names: Sequence[str] = ("total", "average", "largest", "smallest"),
                  exact: bool = False) -> DataFrame:
    """sum, average, max, min of a column in one pass. The average is the
    jobs' integer average (sum div count) unless ``exact`` asks for the
    real one (a double)."""
    c = F.col(col)
    t, a, mx, mn = names
    avg = F.col("_s") / F.col("_n") if exact else int_avg(F.col("_s"), F.col("_n"))
    return (df.agg(F.sum(c).alias("_s"), F.count(c).alias("_n"), F.max(c).alias(mx), F.min(c).alias(mn))
            .select(F.col("_s").cast("bigint").alias(t), F.when(F.col("_n") > 0, avg).alias(a), mx, mn))


def distinct_count(df: DataFrame, cols: str | Sequence[str], name: str = "count") -> DataFrame:
    """Number of distinct non-null values (tuples) of ``cols``."""
    return df.agg(F.count_distinct(*[F.col(c) for c in _list(cols)]).alias(name))


def extreme_records(df: DataFrame, col: str, tie: str, cols: Sequence[str],
                    kind_col: str = "kind") -> DataFrame:
    """The whole records holding the largest and the smallest ``col``
    (ties -> smallest ``tie``; null values never win): two rows, ``kind``
    'max' / 'min', then ``cols``. Any type that can be ordered will do; NaN is
    larger than every number, as in ``max``.

    Two TakeOrderedAndProject: every task keeps its best row only.
    """
    some = df.filter(F.col(col).isNotNull())

    def first(kind: str, order: Column) -> DataFrame:
        return some.orderBy(order, F.asc(tie)).limit(1).select(F.lit(kind).alias(kind_col), *cols)

    return first("max", F.desc(col)).unionByName(first("min", F.asc(col)))


def group_extremes(df: DataFrame, by: str | Sequence[str], col: str,
                   min_name: str = "min", max_name: str = "max") -> DataFrame:
    """min and max of ``col`` per group."""
    return df.groupBy(*_list(by)).agg(F.min(col).alias(min_name), F.max(col).alias(max_name))


STATE = ("_sum", "_count", "_min", "_max")


def group_state(df: DataFrame, by: str | Sequence[str], col: str) -> DataFrame:
    """Per group what later rows can be added to: ``_sum``, ``_count``, ``_min`` and ``_max`` of
    the non-null values of ``col``. Store it, and a day's new rows are all that has to be
    read the next day (``merge_states``)."""
    c = F.col(col)
    return df.groupBy(*_list(by)).agg(F.sum(c).alias("_sum"), F.count(c).alias("_count"), F.min(c).alias("_min"),
                                      F.max(c).alias("_max"))


def merge_states(by: str | Sequence[str], *states: DataFrame) -> DataFrame:
    """The state of all rows from the states of parts of them. Groups may be missing in any
    part; ``by`` may name fewer keys than the states have."""
    keys = _list(by)
    every = reduce(DataFrame.unionByName, [s.select(*keys, *STATE) for s in states])
    return every.groupBy(*keys).agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"), F.min("_min").alias("_min"),
                                    F.max("_max").alias("_max"))


def state_stats(state: DataFrame, by: str | Sequence[str],
                names: Sequence[str] = ("total", "count", "average", "smallest", "largest")) -> DataFrame:
    """Sum, count, average, min and max per group from a state; a group without values
    has a null average."""
    total, count, average, low, high = names
    return state.select(*_list(by), F.col("_sum").alias(total), F.col("_count").alias(count),
                        F.when(F.col("_count") > 0, F.col("_sum") / F.col("_count")).alias(average),
                        F.col("_min").alias(low), F.col("_max").alias(high))


def basket_summary(items: DataFrame, tx_col: str, product_col: str, scale: int = 1,
                   product_name: str = "most_popular_product",
                   avg_name: str = "avg_transaction", by: str | Sequence[str] = (),
                   exact: bool = False) -> DataFrame:
    """Over basket lines: the most frequent non-null product (ties ->
    smallest) and items per transaction = lines div distinct transactions,
    as ``decimal(38, scale)`` (null when there are no lines; ``exact`` gives
    the real ratio rounded half-up instead of the integer division).

    Without ``by`` one row, with ``by`` one row per group. Without it both
    results are derived from ONE aggregate by (transaction, product), read
    unfiltered by both branches; null products lose through an ordering flag
    rather than a filter. With ``by`` the branches share the lines themselves,
    dealt out once by all three columns: the input is often a large join
    already dealt by transaction, where an aggregate by these columns would
    keep nearly every line in two hash maps beside the join's sorts. Naming
    every column keeps any from being pruned in one branch only, so the join
    runs once; as a rebalancing, repeated lines are split by size, and each
    branch combines before its own shuffle.
    """
    gs = _list(by)
    prod = F.col(product_col)
    if gs:
        keys = list(dict.fromkeys([*gs, tx_col, product_col]))
        shared = items.select(*keys).hint("rebalance", *[F.col(c) for c in keys])
        per_prod = shared.groupBy(*dict.fromkeys([*gs, product_col])).agg(F.count(F.lit(1)).alias("_pn"))
        lines, txs = F.count(F.lit(1)), F.count_distinct(tx_col)
    else:
        shared = items.groupBy(tx_col, product_col).agg(F.count(F.lit(1)).alias("_n"))
        per_prod = shared.groupBy(product_col).agg(F.sum("_n").alias("_pn"))
        lines, txs = F.sum("_n"), F.count_distinct(tx_col)
    if exact:  # the real ratio, rounded half-up to ``scale``
        per_tx = F.when(txs > 0, F.round(lines.cast("decimal(38,0)") / txs, scale)).cast(f"decimal(38,{scale})")
    else:  # the jobs' integer division, then ``scale`` digits
        per_tx = int_avg(lines, txs).cast(f"decimal(38,{scale})")
    if not gs:
        popular = (per_prod.orderBy(prod.isNull(), F.desc("_pn"), prod).limit(1)
                   .select(F.when(prod.isNotNull(), prod).alias(product_name)))
        return shared.agg(per_tx.alias(avg_name)).select(popular.scalar().alias(product_name), avg_name)
    best = _Argmax(per_prod, "_pn", product_col, null_key="never")
    popular = (per_prod.groupBy(*gs).agg(best.agg.alias("_m"))
               .select(*gs, best.key(F.col("_m")).alias(product_name)).alias("_p"))
    stats = shared.groupBy(*gs).agg(per_tx.alias(avg_name)).alias("_s")
    # Null-safe keys: a null group is a group too, and no not-null filter is
    # inferred and pushed into one branch only (which would stop the reuse).
    cond = reduce(lambda a, b: a & b, [F.col(f"_s.{g}").eqNullSafe(F.col(f"_p.{g}")) for g in gs])
    return (stats.join(popular, cond, "left")
            .select(*[F.col(f"_s.{g}") for g in gs], F.col(f"_p.{product_name}"), F.col(f"_s.{avg_name}")))


def attach_global(df: DataFrame, agg: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate ``agg`` to every row of ``df``.

    The aggregate runs once as a scalar subquery and its value is inlined
    into the projection: no join, no shuffle of ``df``.
    """
    packed = agg.select(F.struct(*agg.columns).alias("_g")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in agg.columns])
