"""Nearest neighbours by cosine, with a vantage-point tree per shard.

Rows are dealt to shards of bounded size by hash, and each shard becomes a tree:
a vantage point halves its rows by distance, and each half keeps the range of
its distances. A half is skipped if, by the triangle inequality, nothing in it
can be nearer than what was found; ``factor`` multiplies that bound, so that a
factor of one is exact and a larger one skips more. Distances are chords on
the unit sphere, which order rows as the cosine does.

A task holds the trees of a group of shards, of bounded size, and the queries are
streamed past them in blocks, so that a row of the table is sent once and a query
once for each group. What a query found in the trees before bounds (exactly, without
the factor) what it seeks in the next, and only its best of the group are returned.
Nothing is sent to the driver or broadcast.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ._common import stored, trimmed

NEAR = 1e-10  # more than the rounding errors of a dot product of unit vectors
NEAR_CHORD = 1e-7  # and of the chord made of it
HELD = 96 << 20  # about as many bytes of vectors a task holds as trees


def build(units: np.ndarray, leaf: int, seed: int = 0) -> dict[str, np.ndarray]:
    """Tree over unit vectors: ``order`` (rows, so that each node is a range) and per
    node: start, stop, vantage row, children (-1: leaf), and the ranges of the
    distances from the vantage row to the rows of each child."""
    rng = np.random.default_rng(seed)
    order, nodes, todo = np.arange(len(units)), [], [(0, len(units), -1, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        node = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = node
        if b - a <= leaf:
            nodes.append([a, b, -1, -1, -1, 0.0, 0.0, 0.0, 0.0])
            continue
        vantage = order[a + rng.integers(b - a)]
        dist = chord(units[order[a:b]] @ units[vantage])
        half = (b - a) // 2
        by = np.argpartition(dist, half)
        order[a:b], dist = order[a:b][by], dist[by]
        nodes.append([a, b, vantage, -1, -1, dist[:half].min(), dist[:half].max(), dist[half:].min(), dist[half:].max()])
        todo += [(a, a + half, node, 0), (a + half, b, node, 1)]
    table = np.array(nodes, float).reshape(-1, 9)
    return {"order": order, "shape": table[:, :5].astype(np.int64), "range": table[:, 5:]}


def chord(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def search(tree: dict, units: np.ndarray, queries: np.ndarray, k: int, factor: float,
           least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that hold, for each query, the ``k`` rows of the largest
    cosine among those met, and all that tie with the last within ``NEAR``. Rows below
    ``least``, a cosine for each query, may be left out."""
    shape, ranges, order = tree["shape"], tree["range"], tree["order"]
    best = np.full((len(queries), k), -np.inf)
    floor = np.full(len(queries), -np.inf) if least is None else least
    short = queries.astype(np.float32), units.astype(np.float32)
    rough = (units.shape[1] + 8) * 2.0**-23  # more than the rounding errors of their products

    def improve(who: np.ndarray, got: np.ndarray) -> None:
        both = np.concatenate([best[who], got], axis=1)
        best[who] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]

    def bounds(node: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = units[shape[node, 2]]  # to copy most of the queries takes longer than to multiply all
        d = chord((queries @ to)[who] if 2 * len(who) > len(queries) else queries[who] @ to)
        lo1, hi1, lo2, hi2 = ranges[node]
        return np.maximum(d - hi1, lo1 - d), np.maximum(d - hi2, lo2 - d)

    def far(values: np.ndarray) -> np.ndarray:
        return np.where(np.isfinite(values), chord(values), np.inf) + NEAR_CHORD

    todo = [(0, np.arange(len(queries)))]
    while todo:  # first each query goes straight down to its own leaf
        node, who = todo.pop()
        if not len(who):
            continue
        if shape[node, 3] < 0:
            improve(who, queries[who] @ units[order[shape[node, 0]:shape[node, 1]]].T)
            continue
        left, right = bounds(node, who)
        todo += [(shape[node, 3], who[left <= right]), (shape[node, 4], who[left > right])]
    first = best[:, 0].copy()
    best[:] = -np.inf  # the home leaf is met again below; only its bound stays
    found, todo = [], [(0, np.arange(len(queries)))]
    exact = far(floor)
    while todo:
        node, who = todo.pop()
        if not len(who):
            continue
        own = np.maximum(best[who, 0], first[who])
        if shape[node, 3] < 0:
            rows = order[shape[node, 0]:shape[node, 1]]
            bound = np.maximum(own, floor[who]) - NEAR
            may = short[0][who] @ short[1][rows].T >= (bound - rough).astype(np.float32)[:, None]
            q, r = np.divmod(np.flatnonzero(may), len(rows))
            got = np.einsum("ij,ij->i", queries[who[q]], units[rows[r]])
            near = got >= bound[q]
            q, r, got = q[near], r[near], got[near]
            if len(q):  # of the other queries nothing here is among the best
                found.append((who[q], rows[r], got))
                new = np.diff(q, prepend=-1) > 0
                values = np.full((new.sum(), len(rows)), -np.inf)
                values[np.cumsum(new) - 1, r] = got
                improve(who[q[new]], values)
            continue
        left, right = bounds(node, who)
        own, whole = far(own), exact[who]
        todo += [(shape[node, 3 + side], who[(factor * near <= own) & (near <= whole)])
                 for side, near in enumerate((left, right))]
    q, r, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
    keep = s >= np.maximum(best[q, 0], floor[q]) - NEAR
    return q[keep], r[keep]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, added up from the first component to the last, so that equal
    vectors have equal results wherever they stand. A row whose squares, or the
    product of two sums of them, would leave the range of doubles is scaled by a
    power of two."""
    def ranged(v: np.ndarray) -> np.ndarray:
        top = np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]
        return np.ldexp(v, np.where(np.abs(top) > 120, -top, 0))

    def added(v: np.ndarray) -> np.ndarray:
        return np.add.accumulate(v, axis=1)[:, -1] if v.size else np.zeros(len(v))

    a, b = ranged(a), ranged(b)
    return np.clip(added(a * b) / np.sqrt(added(a * a) * added(b * b)), -1, 1)


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # keeps squares of tiny and huge values in range
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def rows_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and vectors, by id and row."""
    row, ids = table["row"].to_numpy(), table["id"].to_numpy()
    v = table["v"].combine_chunks().flatten().to_numpy().reshape(len(row), -1)
    by = np.lexsort((row, ids))
    return row[by], ids[by], v[by]


def plant(part: pa.Table, k: int, leaf: int) -> dict[str, np.ndarray]:
    """The tree of a shard's rows. Equal vectors are one point with the ``k`` + 1
    smallest ids: more can't be asked for."""
    row, ids, v = rows_of(part)
    _, first, point = np.unique(v.view([("", v.dtype)] * v.shape[1]).ravel(), return_index=True, return_inverse=True)
    by = np.argsort(point, kind="stable")
    place = np.arange(len(by)) - np.searchsorted(point[by], point[by])
    keep = by[place <= k]
    v = v[first]
    return {"v": v, "row": row[keep], "id": ids[keep], "starts": np.searchsorted(point[keep], np.arange(len(v) + 1)),
            **build(unit(v.astype(float)), leaf)}


def neighbours(trees: list[dict], lot: pa.Table, k: int, factor: float) -> pa.RecordBatch:
    """The ``k`` best (row, query_id, vec_id, score) of each query among the rows of some trees."""
    asked_rows, asked_ids, asked_v = rows_of(lot)
    asked_v = asked_v.astype(float)
    units, least = unit(asked_v), np.full(len(asked_v), -np.inf)
    best = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for t in trees:
        v = t["v"].astype(float)
        # One more is sought: the query's own row may be among them.
        q, p = search(t, unit(v), units, k + 1, factor, least)
        size = np.diff(t["starts"])[p]
        score = cosines(asked_v[q], v[p])
        each = np.repeat(np.arange(len(q)), size)
        at = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size) + t["starts"][p][each]
        new = q[each], score[each], t["id"][at], t["row"][at]
        other = new[3] != asked_rows[new[0]]
        q, score, ids, row = (np.concatenate([x, y[other]]) for x, y in zip(best, new, strict=True))
        by = np.lexsort((row, ids, -score, q))
        q = q[by]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        by, q, place = by[place < k], q[place < k], place[place < k]
        best = q, score[by], ids[by], row[by]
        least[q[place == k - 1]] = best[1][place == k - 1]
    q, score, ids, _ = best
    return pa.RecordBatch.from_arrays([pa.array(asked_rows[q]), pa.array(asked_ids[q]), pa.array(ids), pa.array(score)],
                                      ["row", "query_id", "vec_id", "score"])


def pieces(batches: Iterator[pa.RecordBatch], names: list[str], most: Callable) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows of equal keys (the columns ``names``), with their key, in pieces
    of ``most(key)`` rows at most."""
    key, some, n = None, [], 0
    for b in batches:
        keys = np.stack([b.column(x).to_numpy().astype(np.int64) for x in names])
        ends = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        for start, stop in pairwise([0, *ends.tolist(), b.num_rows]):
            while start < stop:
                now = tuple(keys[:, start].tolist())
                if some and (now != key or n >= most(key)):
                    yield key, pa.Table.from_batches(some)
                    some, n = [], 0
                key, take = now, min(stop - start, most(now) - n)
                some.append(b.slice(start, take))
                start, n = start + take, n + take
    if some:
        yield key, pa.Table.from_batches(some)


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, v, dim) of the rows that take part, stored; v in single precision if it
    comes so, else in double."""
    kind = table.select(vector_col).schema[0].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.transform(F.col(vector_col).cast("array<float>" if single else "array<double>"), lambda x: x)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    read = table.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(
        "id is not null and v is not null and size(v) > 0")
    return stored(read.where(~bad & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))
                  .withColumn("row", F.monotonically_increasing_id()), "op9-vectors")


def nearest(table: DataFrame, queries: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
            factor: float = 1.25, shard_rows: int = 8192, leaf: int = 64, block_rows: int = 4096) -> DataFrame:
    """For each row of ``table`` where ``queries`` (a condition on ``id``) holds, its
    ``k`` nearest among all other rows: query_id, rank (from 1), vec_id, score
    (cosine in double precision), ties to the smaller id.

    Rows of null id, or whose vector is null, empty, zero, or holds a null or
    non-finite value, take no part; vectors of other lengths don't meet. With
    fewer than ``k`` others, all. A row is not its own neighbour, other rows of
    the same id are; repeated query rows have results each. With ``factor`` 1
    the result is exact; a shard holds about ``shard_rows`` rows, or fewer if these
    take more than ``HELD`` bytes.
    """
    if factor < 1:
        raise ValueError("factor must be 1 or more")
    all_rows = vectors(table, id_col, vector_col)
    n, values = all_rows.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    size = 4 if isinstance(all_rows.schema["v"].dataType.elementType, T.FloatType) else 8
    least, cores = -(-values * size // HELD), table.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n // shard_rows), least)  # what they hold doesn't depend on the number of groups
    groups = max(least, min(shards, 4 * cores))

    planted = all_rows.select("dim", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards)).alias("shard"), "row", "id", "v")
    planted = planted.withColumn("group", F.col("shard") % groups)
    # The queries follow the last shard of each group.
    asked = all_rows.where(queries).select(
        "dim", F.lit(shards).cast("bigint").alias("shard"), "row", "id", "v",
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1).cast("bigint"))).alias("group"))
    keys = ["dim", "group", "shard"]
    # More partitions than groups: few of them get two.
    sent = planted.unionByName(asked).repartition(4 * groups, "dim", "group").sortWithinPartitions(*keys)

    @trimmed
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for (dim, number, shard), part in pieces(batches, keys, lambda key: block_rows if key[2] == shards else n):
            if group != (dim, number):
                held, group = [], (dim, number)
            if shard < shards:
                held.append(plant(part, k, leaf))
            elif held:
                yield neighbours(held, part, k, factor)

    met = sent.mapInArrow(find, "row bigint, query_id bigint, vec_id bigint, score double")
    by = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
