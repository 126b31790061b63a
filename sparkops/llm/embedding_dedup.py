"""Near-duplicate vectors: an exact range join by cosine over pivots.

The metric is the angle between vectors. A pair links if its cosine is ``least`` or
more, so if its angle is at most ``r = acos(least)``. Pivots are chosen from a
bounded sample (parameter ``sample_rows``), dense places first, none within ``r`` of
another. Each vector belongs to the cell of its nearest pivot; every vector is
assigned, whatever the sample held.

Boundary replication: a vector ``v`` of cell ``i`` can have a partner in cell ``j`` only if,
by the triangle inequality, ``d(v, p_j) - d(v, p_i) <= 2 r`` (the partner is no farther
from ``p_j`` than from ``p_i``) and ``d(v, p_j) <= r + radius_j``. Then it visits cell ``j``,
if ``i < j``: each pair is met in one cell only. Cells join independently, in blocks of
at most some ``block_rows`` vectors, so no task holds a whole cell.

The core of a cell, the vectors within ``r / 2`` of its pivot, needs no comparison: all
its pairs link, again by the triangle inequality. Its links are counted and its
members are connected through one of them. So a crowd of near copies around a pivot
costs no more than its rows. Equal vectors are one point of the join that counts as
often as it occurs.

Tasks return counts and, in place of links, each vector's root among the vectors it
met: as many rows as vectors, however many pairs link.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from sparkops.operators.joins import salted_join

from ._common import Store, sized, trimmed
from .ngram_join import components
from .vp_tree import cosines, packed, unit

NEAR = 1e-9  # more than the rounding errors of a dot product of unit vectors
WIDE = 1e-6  # more than those of an angle made of it


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, a row each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def choose_pivots(vectors: np.ndarray, most: int, r: float) -> np.ndarray:
    """Of some vectors at most ``most``, those with the most others within ``r / 2``
    first, none within ``r`` of one taken before."""
    u = unit(vectors)
    d = angle(u @ u.T)
    left, taken = np.ones(len(u), bool), []
    for i in np.argsort(-(d <= r / 2).sum(axis=1), kind="stable"):
        if left[i]:
            taken.append(i)
            left &= d[i] > r
        if len(taken) == most:
            break
    return u[taken]


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (the smallest member of each component) once items a and b are linked."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, up := root[root]):
            root = up


def met(one: np.ndarray, two: np.ndarray | None, least: float, times1: np.ndarray, times2: np.ndarray | None,
        rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks of vectors, or inside one (``two`` None): for each
    vector (of both, in order) the number of links, and its root. Pairs that differ
    from the bound by less than ``NEAR`` are decided on the vectors themselves."""
    inside = two is None
    u1 = unit(one)
    u2, v2, t2 = (u1, one, times1) if inside else (unit(two), two, times2)
    links1, links2 = np.zeros(len(one), np.int64), np.zeros(0 if inside else len(two), np.int64)
    root = np.arange(len(one) + len(links2))
    shift = 0 if inside else len(one)
    for at in range(0, len(one), rows):
        cos = u1[at:at + rows] @ u2.T
        link = cos >= least + NEAR
        near = np.nonzero(np.abs(cos - least) < NEAR)
        if len(near[0]):
            link[near] = cosines(one[at + near[0]], v2[near[1]]) >= least
        if inside:
            k = np.arange(len(link))
            link[k, at + k] = False
        i, j = np.nonzero(link)
        if len(i):
            links1[at:at + rows] += link @ t2
            if not inside:
                links2 += times1[at:at + rows] @ link
            root = unite(root, i + at, j + shift)
    return np.concatenate([links1, links2]), root


def points_of(table: DataFrame, id_col: str, vector_col: str, store: Store) -> tuple[DataFrame, DataFrame]:
    """All rows (row, id, h1, h2; hashes null if the vector takes no part), and the
    distinct vectors (pid, h1, h2, dim, v, times, id: the smallest)."""
    v = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    fit = F.col("v").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0)
    plain = F.transform("v", lambda x: x + F.lit(0.0))  # one zero
    rows = table.select(F.col(id_col).alias("id"), v.alias("v")).withColumn("v", F.when(fit, plain))
    rows = store.put(rows.withColumn("h1", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
                     .withColumn("h2", F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v"))), "rows")
    points = rows.where("v is not null").groupBy("h1", "h2").agg(
        F.first("v").alias("v"), F.count("*").alias("times"), F.min("id").alias("id"))
    points = store.put(points.withColumn("dim", F.size("v")).withColumn("pid", F.monotonically_increasing_id()), "points")
    return rows, points


def pivots_of(points: DataFrame, count: int, r: float, cell_rows: int, most: int, sample_rows: int) -> dict[int, np.ndarray]:
    """Pivots by vector length, from the ``sample_rows`` points of the smallest hashes.
    Lengths that the sample lacks are a cell each."""
    sample = points.orderBy(F.xxhash64("h1", "h2")).limit(sample_rows).select("dim", "v").toArrow()
    out = {}
    for dim in sorted(set(sample["dim"].to_pylist())):
        own = sample.filter(pc.equal(sample["dim"], dim))
        out[dim] = choose_pivots(matrix(own["v"]), max(1, min(most, math.ceil(count / cell_rows))), r)
    return out


PLACED = "pid bigint, times bigint, dim int, v array<double>, cell int, d double, core boolean, visits array<int>"


def place(points: DataFrame, pivots: Broadcast, r: float) -> DataFrame:
    """Each point with its cell, its distance from the pivot, whether it is in the core,
    and the later cells that it may visit by the pivots' distances alone."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for dim in np.unique(whole.column("dim").to_numpy()).tolist():
                b = whole.filter(pc.equal(whole.column("dim"), dim))
                n = b.num_rows
                if dim in pivots.value:
                    far = angle(unit(matrix(b.column("v"))) @ pivots.value[dim].T)
                    cell = far.argmin(axis=1)
                    d = far[np.arange(n), cell]
                    may = (far - d[:, None] <= 2 * r + WIDE) & (np.arange(far.shape[1]) > cell[:, None])
                else:
                    cell, d, may = np.zeros(n, int), np.full(n, math.pi), np.zeros((n, 1), bool)
                offsets = np.concatenate([[0], np.cumsum(may.sum(axis=1))]).astype(np.int32)
                visits = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.nonzero(may)[1].astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("pid"), b.column("times"), b.column("dim"), b.column("v"), pa.array(cell.astype(np.int32)),
                     pa.array(d), pa.array(d <= r / 2 - WIDE), visits],
                    ["pid", "times", "dim", "v", "cell", "d", "core", "visits"])

    return points.select("pid", "times", "dim", "v").mapInArrow(run, PLACED)


def visiting(trips: DataFrame, pivots: Broadcast, r: float) -> DataFrame:
    """Visitors of a cell, with their distance from its pivot, if its radius lets them
    have a partner there."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for dim in np.unique(whole.column("dim").to_numpy()).tolist():
                b = whole.filter(pc.equal(whole.column("dim"), dim))
                to = b.column("cell").to_numpy()
                d = angle((unit(matrix(b.column("v"))) * pivots.value[dim][to]).sum(axis=1))
                near = pa.array(d <= r + b.column("radius").to_numpy() + WIDE)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in ("dim", "cell", "pid", "times", "v")), pa.array(d)],
                    ["dim", "cell", "pid", "times", "v", "d"]).filter(near)

    return (trips.select("dim", "cell", "radius", "pid", "times", "v")
            .mapInArrow(run, "dim int, cell int, pid bigint, times bigint, v array<double>, d double")
            .select("dim", "cell", F.lit(VISITOR).alias("kind"), "pid", "times", "v", "d"))


# Kinds of blocks of a cell.
CORE, RIM, VISITOR = 0, 1, 2


def pack(key, part):
    """The vectors of one block as bytes, in order of their ids."""
    part = part.sort_by("pid")
    blob = packed(pid=part["pid"].to_numpy(), v=matrix(part["v"]), times=part["times"].to_numpy(), d=part["d"].to_numpy())
    names = ["dim", "cell", "kind", "block"]
    return pa.table([pa.array([k.as_py()], t) for k, t in zip(key, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)]
                    + [pa.array([blob], pa.binary())], names=[*names, "blob"])


def load(blob: bytes) -> dict[str, np.ndarray]:
    made = np.load(io.BytesIO(blob))
    return {k: made[k] for k in made.files}


def joined(least: float, r: float):
    """The work on pairs of blocks (one, two; ``two`` null: one block with itself)."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob1, blob2 in zip(b.column("one"), b.column("two"), strict=True):
                one = load(blob1.as_py())
                two = load(blob2.as_py()) if blob2.is_valid else None
                if two is not None:
                    # Partners' distances from the cell's pivot differ by r at most.
                    for x, y in ((one, two), (two, one)):
                        if len(y["d"]) and len(x["d"]):
                            keep = (x["d"] >= y["d"].min() - r - WIDE) & (x["d"] <= y["d"].max() + r + WIDE)
                            x.update({k: v[keep] for k, v in x.items()})
                    if not len(one["d"]) or not len(two["d"]):
                        continue
                links, root = met(one["v"], None if two is None else two["v"], least, one["times"],
                                  None if two is None else two["times"])
                pid = one["pid"] if two is None else np.concatenate([one["pid"], two["pid"]])
                some = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(pid[some]), pa.array(links[some]), pa.array(pid[root][some])],
                                                 ["pid", "links", "root"])

    return run


def range_join(points: DataFrame, store: Store, *, least: float, cell_rows: int, block_rows: int, most_pivots: int,
               sample_rows: int) -> DataFrame:
    """(pid, links, root) of the linked points, several rows each: numbers of links to add
    up, and another point of the same component."""
    r = math.acos(least)
    pivots = points.sparkSession.sparkContext.broadcast(
        pivots_of(points, points.count(), r, cell_rows, most_pivots, sample_rows))
    placed = store.put(place(points, pivots, r), "placed")
    # A row a pivot, and one for each vector length that the sample lacks.
    cells = store.put(placed.groupBy("dim", "cell").agg(
        F.max("d").alias("radius"), F.sum(F.when(F.col("core"), F.col("times"))).alias("core_times"),
        F.min(F.when(F.col("core"), F.col("pid"))).alias("core_root")), "cells")
    trips = placed.drop("cell").withColumn("cell", F.explode("visits")).join(
        sized(cells.select("dim", "cell", "radius"), 100_000), ["dim", "cell"])
    homes = placed.select("dim", "cell", F.when(F.col("core"), CORE).otherwise(RIM).alias("kind"), "pid", "times", "v", "d")
    everyone = store.put(homes.unionByName(visiting(trips, pivots, r)), "everyone")
    pivots.destroy()
    # Each kind of each cell is dealt by hash into as many blocks as keep them small.
    sizes = store.put(everyone.groupBy("dim", "cell", "kind").agg(
        F.ceil(F.count("*") / F.lit(block_rows)).alias("blocks")), "sizes")
    dealt = everyone.join(sized(sizes, 300_000), ["dim", "cell", "kind"]).withColumn(
        "block", F.pmod(F.xxhash64("pid"), F.col("blocks"))).drop("blocks")
    blocks = store.put(dealt.groupBy("dim", "cell", "kind", "block").applyInArrow(
        pack, "dim int, cell int, kind int, block bigint, blob binary"), "blocks")
    store.drop("everyone", "sizes")
    one, two = (blocks.select("dim", "cell", F.col("kind").alias(f"kind{i}"), F.col("block").alias(f"block{i}"),
                              F.col("blob").alias(name)) for i, name in ((1, "one"), (2, "two")))
    # Core meets rim and visitors, rim meets rim and visitors.
    order = (F.col("kind1") < F.col("kind2")) | (
        (F.col("kind1") == RIM) & (F.col("kind2") == RIM) & (F.col("block1") < F.col("block2")))
    pairs = one.join(two, ["dim", "cell"]).where(order).select("one", "two")
    alone = blocks.where(F.col("kind") == RIM).select(F.col("blob").alias("one"), F.lit(None).cast("binary").alias("two"))
    found = pairs.unionByName(alone).mapInArrow(joined(least, r), "pid bigint, links bigint, root bigint")
    core = placed.where("core").join(sized(cells, 100_000), ["dim", "cell"]).select(
        "pid", (F.col("core_times") - F.col("times")).alias("links"), F.col("core_root").alias("root"))
    return store.put(found.unionByName(core), "found")


def embedding_dedup(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95,
                    cell_rows: int = 4096, block_rows: int = 4096, most_pivots: int = 1024,
                    sample_rows: int = 2048) -> DataFrame:
    """Per row of ``table``: the id, ``n_links`` (other rows whose cosine, in double
    precision, is ``least`` or more), ``component_id`` (the smallest id reachable over
    links, itself included) and ``kept`` (whether that is its own id).

    Vectors that are null, empty, zero or hold a null or a non-finite component link
    with nothing and keep their own id, as do vectors of a length that no other has.
    Equal vectors link with each other. Null ids take part and are passed over for the
    smallest id; a component of null ids only has none, and its rows are kept. Rows of
    equal ids are rows of their own. Distinct vectors are told apart by 128 bits of hash.
    An empty table has no rows; other columns are not read.
    """
    if not 0 < least < 1:
        raise ValueError("least must be between 0 and 1")
    store = Store(table.sparkSession, "op12")
    rows, points = points_of(table, id_col, vector_col, store)
    found = range_join(points, store, least=least, cell_rows=cell_rows, block_rows=block_rows, most_pivots=most_pivots,
                       sample_rows=sample_rows)
    store.drop("placed", "blocks", "cells")
    roots = components(found.select(F.col("pid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("pid").agg(F.sum("links").alias("links"))
    classes = (points.select("pid", "h1", "h2", "times", "id").join(links, "pid", "left")
               .join(roots.select(F.col("node").alias("pid"), "root"), "pid", "left")
               .withColumn("root", F.coalesce("root", "pid")))
    classes = store.put(classes, "classes")
    least_id = classes.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = store.put(salted_join(classes, least_id, "root", "pid").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"), "classed")
    store.drop("found", "points")
    out = salted_join(rows.select("id", "h1", "h2").withColumn("row", F.monotonically_increasing_id()), classes,
                      ["h1", "h2"], "row", how="left")
    component = F.when(F.col("h1").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
