"""Mixing sources to target weights by temperature.

The weight of a source is its share of the tokens, raised to an exponent and
normalised. An exponent of one keeps the shares, zero makes all sources equal.
The exponent is bisected to the target entropy, and raised where that would
repeat a source more often than the limit. The weights become token budgets.
Each source's documents lie in blocks of about equal size; a budget takes the
blocks in the order of a keyed permutation, whole rounds first, and cuts the
last block within.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._common import stored


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("bigint")


def moments(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy in nats, sum of the powers, largest weight over share) of the
    weights at each exponent; one aggregation over the table of sources."""
    power = F.pow("share", "a")
    rows = (shares.withColumn("a", F.explode(F.array(*map(F.lit, exponents)))).groupBy("a")
            .agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("s"),
                 F.max(power / F.col("share")).alias("r")).collect())
    found = {r.a: (math.log(r.z) - r.a * r.s / r.z, r.z, r.r / r.z) for r in rows}
    return [found[a] for a in exponents]


def bisect(shares: DataFrame, holds, low: float, high: float, rounds: int = 5, halvings: int = 6) -> tuple[float, float]:
    """The ends of the interval in which ``holds`` (of the moments at an exponent) goes
    from true at ``low`` to false at ``high``, after ``rounds * halvings`` halvings:
    each round looks at all middles that its halvings may come to in one job."""
    parts = 1 << halvings
    for _ in range(rounds):
        grid = [low + (high - low) * i / parts for i in range(parts + 1)]
        found = moments(shares, grid[1:-1])
        at, width = 0, parts
        while width > 1:
            width //= 2
            at += width if holds(found[at + width - 1]) else 0
        low, high = grid[at], grid[at + 1]
    return low, high


def exponent_for(shares: DataFrame, entropy_share: float | None, repeats: float, fill: float) -> float:
    """The exponent whose weights have ``entropy_share`` of the largest entropy (the
    one of equal weights), or the next larger one at which no source's budget is
    over ``repeats`` times its tokens; ``fill`` is the budget over all tokens."""
    equal, same = moments(shares, [0.0, 1.0])
    alpha = 1.0  # the largest that is enough changes least
    if entropy_share is not None and same[0] < entropy_share * equal[0]:
        alpha = bisect(shares, lambda m: m[0] >= entropy_share * equal[0], 0.0, 1.0)[0]
    if moments(shares, [alpha])[0][2] * fill <= repeats:
        return alpha
    return bisect(shares, lambda m: m[2] * fill > repeats, alpha, 1.0)[1]  # at 1 every source is repeated alike


def mix(docs: DataFrame, *, source_col: str = "source", text_col: str = "text", tokens: Column | None = None,
        key: Column | None = None, entropy_share: float | None = 0.97, repeats: float = 2.0, fill: float = 1.0,
        block_tokens: int = 50_000, seed: int = 17) -> DataFrame:
    """Rows of ``docs``, each as often as the mixture takes it, with ``mix_round`` (from
    0), ``mix_block`` (its block in the source), ``mix_place`` (the order of the
    blocks in a round) and ``mix_tokens``.

    ``tokens`` counts a row's tokens (by default its words); ``key`` decides the
    block and the place inside (by default the text). A budget is a source's
    weight times ``fill`` times all tokens; rows are taken while the sum before
    them is below it. ``repeats`` must be at least ``fill``. A null source is a
    source; rows without tokens go along with their block's first row, and the rows
    of a source that has no tokens at all stay, once each, as block 0. Equal
    rows lie in one block and are ordered arbitrarily, so results don't depend
    on which is which. Without any tokens all rows stay, once.
    """
    if repeats < fill:
        raise ValueError("repeats must be at least fill")
    names = docs.columns
    # The row's own columns go into one, so that no name can clash.
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in names)).alias("doc"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       F.col(source_col).isNull().alias("unnamed"),
                       (word_count(F.col(text_col)) if tokens is None else tokens).alias("n"),
                       F.coalesce(F.xxhash64(F.col(text_col) if key is None else key), F.lit(0)).alias("h"))
    by_source = stored(rows.groupBy("source", "unnamed").agg(F.sum("n").alias("t"), F.count("*").alias("rows"),
                                                             F.min("h").alias("least")), "op2-sources")
    total = by_source.agg(F.sum("t")).first()[0] or 0
    out = [F.col("doc")[c].alias(c) for c in names]
    zero = F.lit(0).cast("bigint")
    once = [*out, zero.cast("int").alias("mix_round"), zero.alias("mix_block"), zero.alias("mix_place"), F.col("n").alias("mix_tokens")]
    if not total:
        return rows.select(*once)
    shares = stored(by_source.where("t > 0").withColumn("share", F.col("t") / total), "op2-shares")
    alpha = exponent_for(shares, entropy_share, repeats, fill)
    z = moments(shares, [alpha])[0][1]
    budget = F.floor(F.pow("share", F.lit(alpha)) / z * (fill * total) + 0.5)
    plan = shares.select("source", "unnamed", "t", budget.alias("budget"),
                         F.ceil(F.col("t") / block_tokens).alias("blocks"))
    plan = stored(plan.withColumn("whole", F.floor(F.col("budget") / F.col("t")))
                  .withColumn("rest", F.col("budget") % F.col("t")), "op2-plan")

    def placed(seed_round: Column, *of: str) -> Column:
        return F.xxhash64(F.lit(seed), seed_round.cast("int"), *of)  # the hash depends on the type

    dealt = rows.join(plan, ["source", "unnamed"]).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(seed), "h"), F.col("blocks")))
    # Only the last, partial round needs to know which blocks come first.
    sizes = dealt.groupBy("source", "unnamed", "block").agg(F.sum("n").alias("size"), F.first("whole").alias("whole"),
                                                            F.first("rest").alias("rest"))
    # Prefix sums in two levels, so that no task orders all blocks of a source: inside
    # each of 1,024 ranges of the order, and over the ranges.
    sizes = sizes.withColumn("order", placed(F.col("whole"), "source", "block")).withColumn("range", F.shiftright("order", 54))
    before = (Window.unboundedPreceding, -1)
    inner = Window.partitionBy("source", "unnamed", "range").orderBy("order", "block").rowsBetween(*before)
    sizes = stored(sizes.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0))), "op2-ordered")
    ranges = sizes.groupBy("source", "unnamed", "range").agg(F.sum("size").alias("base"))
    outer = Window.partitionBy("source", "unnamed").orderBy("range").rowsBetween(*before)
    ranges = ranges.withColumn("base", F.coalesce(F.sum("base").over(outer), F.lit(0)))
    sizes = stored(sizes.join(ranges, ["source", "unnamed", "range"]).withColumn(
        "left", F.col("rest") - F.col("base") - F.col("before")), "op2-blocks")
    joined = dealt.select("doc", "source", "unnamed", "n", "h", "block", "whole").join(
        sizes.select("source", "unnamed", "block", "size", "left"), ["source", "unnamed", "block"])
    # The block in which the budget ends is cut inside, in the order of the rows' hashes.
    edge = (F.col("left") > 0) & (F.col("left") < F.col("size"))
    inside = Window.partitionBy("source", "unnamed", "block").orderBy(placed(F.col("whole"), "h"), "h").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = joined.where(edge).withColumn("sum", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    cut = cut.withColumn("more", (F.col("sum") < F.col("left")).cast("int")).drop("sum")
    full = joined.where(~edge).withColumn("more", (F.col("left") > 0).cast("int"))
    times = (F.col("whole") + F.col("more")).cast("int")
    taken = full.unionByName(cut).where(times > 0).withColumn(
        "round", F.explode(F.sequence(F.lit(0), times - 1)))
    mixed = taken.select(*out, F.col("round").alias("mix_round"), F.col("block").alias("mix_block"),
                         placed(F.col("round"), "source", "block").alias("mix_place"), F.col("n").alias("mix_tokens"))
    silent = by_source.where("coalesce(t, 0) <= 0").select("source", "unnamed")
    if not silent.limit(1).count():
        return mixed
    return mixed.unionByName(rows.join(silent, ["source", "unnamed"]).select(*once))
