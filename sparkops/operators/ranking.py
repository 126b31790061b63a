"""Ranking: top-k per group, word counts, rank-aligned zips, winners and
their extreme locations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkops._cols import as_list as _list
from sparkops.functions.text import words
from sparkops.session import scratch_path


# Spark limits rows per group before the shuffle up to this k
# (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000


def top_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int,
                  rank_col: str = "rank", spread: int = 64) -> DataFrame:
    """First ``k`` rows of every ``by`` group in ``order``; ``rank_col`` 1..k.

    Up to k = 1000 Spark inserts a partial WindowGroupLimit before the shuffle,
    so each task ships at most ``k`` rows per group. Beyond, a first ranking
    inside ``spread`` parts of each group leaves at most ``spread * k`` of its
    rows to the second, so that no group is sorted whole in one task.
    """
    keys = _list(by)
    if k > _GROUP_LIMIT:
        part = "_part"
        dealt = df.withColumn(part, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread)))
        inner = Window.partitionBy(*keys, part).orderBy(*order)
        df = dealt.withColumn(rank_col, F.row_number().over(inner)).filter(F.col(rank_col) <= k).drop(part, rank_col)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def word_count(df: DataFrame, text_col: str, by: Sequence[str] = (),
               word_col: str = "value", count_col: str = "count") -> DataFrame:
    """Occurrences of every lower-cased word token (``\\W+`` separated).

    Empty tokens are dropped; a null text counts nothing. Counting is a
    partial aggregation, so frequent words are combined in every task.
    """
    tokens = df.select(*by, F.explode(words(text_col)).alias(word_col))
    return (tokens.filter(F.col(word_col) != "")
            .groupBy(*by, word_col).agg(F.count(F.lit(1)).alias(count_col)))


def zip_by_rank(counts: DataFrame, side_col: str, sides: Sequence[str], word_col: str,
                count_col: str, limit: int = 20,
                names: Sequence[str] = ("w_s1", "cnt_s1", "id", "w_s2", "cnt_s2")) -> DataFrame:
    """Align the ranked words of two sides: row ``i`` holds the i-th word of
    each side, for i = 0 .. ``limit`` inclusive, ending at the shorter side.

    Ranking is by count descending, then word. ``counts`` holds both sides,
    told apart by ``side_col``.
    """
    left, right = sides
    side = F.col(side_col)
    top = top_per_group(counts.filter(side.isin(left, right)), side_col,
                        [F.desc(count_col), F.asc(word_col)], limit + 1, "_rn")
    w1, c1, idn, w2, c2 = names

    def pick(which, c):
        return F.max(F.when(side == which, F.col(c)))

    # Both sides come out of one window; a small aggregation over at most
    # 2 * (limit + 1) rows lines them up by rank (one scan, no self-join).
    # Ranks present on one side only are dropped: the zip ends at the
    # shorter side.
    z = top.groupBy("_rn").agg(pick(left, word_col).alias(w1), pick(left, count_col).alias(c1),
                               pick(right, word_col).alias(w2), pick(right, count_col).alias(c2))
    return (z.filter(F.col(c1).isNotNull() & F.col(c2).isNotNull())
            .select(w1, F.col(c1).cast("bigint").alias(c1), (F.col("_rn") - 1).cast("int").alias(idn),
                    w2, F.col(c2).cast("bigint").alias(c2)))


def rank_rows(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], rank_col: str = "rank",
              block: int = 1024) -> DataFrame:
    """All rows of ``df`` with their place, from 1, among the rows of their ``by`` group in
    ``order``, for groups of any size: no group is ordered in one task.

    Rows are dealt out by ranges of (group, order) and sorted inside; a row's place is
    its place inside its part plus the rows of its group in earlier parts. Those are
    prefix sums over a row for each part and group, in two levels of ``block`` parts. The
    sorted rows are stored in the shared scratch folder first, so that places and sums
    are of the same parts. ``order`` should leave no ties; if it does, equal rows
    get places in any order.
    """
    keys, spark = _list(by), df.sparkSession
    path = scratch_path(spark, "ranked")
    # Null-safe group keys for the join below.
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))
    tagged = df.withColumn("_g", F.to_json(group, {"ignoreNullFields": "false"}))
    (tagged.repartitionByRange("_g", *order).sortWithinPartitions("_g", *order)
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy("_g", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    parts = parts.withColumn("_block", F.floor(F.col("_part") / block))
    inner = Window.partitionBy("_g", "_block").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    blocks = parts.groupBy("_g", "_block").agg(F.sum("_n").alias("_bn"))
    all_blocks = F.array_sort(F.collect_list(F.struct("_block", "_bn")))  # parts / block of them
    earlier = blocks.groupBy("_g").agg(all_blocks.alias("_all")).select("_g", F.explode("_all").alias("_b"), "_all").select(
        "_g", F.col("_b._block").alias("_block"),
        F.aggregate(F.filter("_all", lambda x: x.getField("_block") < F.col("_b._block")), F.lit(0).cast("bigint"),
                    lambda s, x: s + x.getField("_bn")).alias("_base"))
    starts = parts.join(earlier, ["_g", "_block"]).select("_g", "_part", (F.col("_before") + F.col("_base") - F.col("_first") + 1).alias("_shift"))
    return rows.join(starts, ["_g", "_part"]).withColumn(rank_col, F.col("_at") + F.col("_shift")).drop("_g", "_part", "_at", "_shift")


def zip_all_ranks(counts: DataFrame, side_col: str, sides: Sequence[str], word_col: str, count_col: str,
                  names: Sequence[str] = ("w_s1", "cnt_s1", "id", "w_s2", "cnt_s2")) -> DataFrame:
    """``zip_by_rank`` over the whole of both sides: row ``i`` holds the i-th word of each,
    for i from 0 to the end of the shorter side. Ranks are found by ``rank_rows``, then
    the sides are joined by rank, so neither is ever in one task."""
    w1, c1, idn, w2, c2 = names
    both = counts.filter(F.col(side_col).isin(*sides)).select(F.col(side_col).alias("_s"), F.col(word_col).alias("_w"), F.col(count_col).alias("_c"))
    ranked = rank_rows(both, "_s", [F.desc("_c"), F.asc("_w")], "_rank")
    one, two = (ranked.filter(F.col("_s") == s).select((F.col("_rank") - 1).alias(idn), F.col("_w").alias(w), F.col("_c").cast("bigint").alias(c))
                for s, w, c in ((sides[0], w1, c1), (sides[1], w2, c2)))
    return one.join(two, idn).select(w1, c1, idn, w2, c2)


def _min_first(*fields: Column) -> Column:
    return F.min(F.struct(*fields))


def top_entity_extremes(df: DataFrame, entities: Mapping[str, str], location: str,
                        measure: str) -> DataFrame:
    """For each entity kind (e.g. company, job): the entity with the largest
    total ``measure`` (empty names excluded, ties by name), then among that
    entity's non-null locations the one with the largest and the smallest
    total (ties by location).

    Result: ``name, type, location, count, count_type`` with two rows
    ('max', 'min') per kind. One partial aggregation by (kind, name,
    location) feeds everything else; winners are found with ordered
    ``min(struct)`` aggregates instead of sorting whole groups.
    """
    kinds = F.array(*[F.struct(F.lit(t).alias("type"), F.col(c).cast("string").alias("name"))
                      for t, c in entities.items()])
    base = (df.select(F.explode(kinds).alias("_e"), F.col(location).alias("location"),
                      F.col(measure).alias("_m"))
            .select("_e.type", "_e.name", "location", "_m")
            .filter(F.col("name").isNotNull()))
    # One shared aggregate. Both branches below read it unfiltered, so Spark
    # runs its scan and shuffle once (ReusedExchange); exclusions are made by
    # ordering flags inside the aggregates and by filters on their results.
    per_loc = base.groupBy("type", "name", "location").agg(F.sum("_m").alias("count"))

    totals = per_loc.groupBy("type", "name").agg(F.sum("count").alias("_t"))
    t = F.col("_t")
    winners = (totals.groupBy("type")
               .agg(_min_first((F.col("name") == "").alias("e"), t.isNull().alias("z"), (-t).alias("k"),
                               F.col("name")).alias("_w"))
               .filter(~F.col("_w.e"))
               .select("type", F.col("_w.name").alias("name")))
    # One winner per kind: a broadcast bounded by len(entities).
    locs = per_loc.join(F.broadcast(winners), ["type", "name"])
    c, loc = F.col("count"), F.col("location")
    ext = locs.groupBy("type", "name").agg(
        _min_first(loc.isNull().alias("l"), c.isNull().alias("z"), (-c).alias("k"), loc).alias("_mx"),
        _min_first(loc.isNull().alias("l"), c.isNull().alias("z"), c.alias("k"), loc).alias("_mn"))
    rows = F.array(
        F.struct(F.col("_mx.location").alias("location"), (-F.col("_mx.k")).alias("count"),
                 F.lit("max").alias("count_type")),
        F.struct(F.col("_mn.location").alias("location"), F.col("_mn.k").alias("count"),
                 F.lit("min").alias("count_type")))
    return (ext.select("name", "type", F.explode(rows).alias("_r"))
            .select("name", "type", "_r.location", "_r.count", "_r.count_type")
            .filter(F.col("location").isNotNull()))
