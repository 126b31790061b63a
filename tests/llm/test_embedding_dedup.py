"""The range join of vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkops.llm.embedding_dedup import choose_pivots, embedding_dedup, met
from sparkops.llm.vp_tree import cosines, unit


def plain(ids, vectors, least=0.95):
    """n_links, component and kept of each row, by all pairs."""
    fit = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n, links = len(ids), [set() for _ in ids]
    for i in range(n):
        for j in range(i):
            if fit[i] and fit[j] and len(vectors[i]) == len(vectors[j]) and cosines(
                    np.array([vectors[i]], float), np.array([vectors[j]], float))[0] >= least:
                links[i].add(j)
                links[j].add(i)
    out, comp = [], [None] * n
    for i in range(n):
        if comp[i] is None:
            todo, own = [i], {i}
            while todo:
                for j in links[todo.pop()] - own:
                    own.add(j)
                    todo.append(j)
            named = [ids[j] for j in own if ids[j] is not None]
            for j in own:
                comp[j] = (min(named) if named else None,)
        out.append((ids[i], len(links[i]), comp[i][0], ids[i] == comp[i][0]))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def clustered(rng, n, dim, spread):
    centres = rng.normal(size=(6, dim))
    v = centres[rng.integers(6, size=n)] + spread * rng.normal(size=(n, dim))
    v[: n // 3] = centres[0] + spread / 8 * rng.normal(size=(n // 3, dim))  # a crowd of near copies
    v[n // 3: n // 2] = v[0]  # and one of copies
    return v


@pytest.mark.parametrize("seed,dim,spread", [(0, 3, 0.15), (1, 8, 0.2), (2, 24, 0.15), (3, 2, 0.3)])
def test_equals_all_pairs(spark, seed, dim, spread):
    rng = np.random.default_rng(seed)
    v = clustered(rng, 150, dim, spread)
    v = [(x * s).tolist() for x, s in zip(v, rng.choice([1.0, 1e-3, 7.0], len(v)))]
    v += [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [float("inf")] * dim,
          [1.0] * (dim + 1), [2.0] * (dim + 1), [-0.0] * (dim - 1) + [1.0], [0.0] * (dim - 1) + [1.0], [5.0], [1e-180] * dim]
    ids = [None if rng.random() < 0.05 else int(x) for x in rng.permutation(len(v))]
    ids[3] = ids[4]
    table = spark.createDataFrame(list(zip(ids, v)), "vec_id long, embedding array<double>").repartition(5)
    for clash in ("id", "pid", "v", "h1", "root", "cell", "d"):
        table = table.withColumn(clash, F.lit(1))
    got = rows_of(embedding_dedup(table, cell_rows=12, block_rows=10, sample_rows=60))
    assert got == plain(ids, v)
    assert rows_of(embedding_dedup(table)) == got  # one cell


def test_bound_itself_and_empty_table(spark):
    # cos = 0.6 exactly, and a hair less.
    rows = [(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.6 - 1e-12, 0.8])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup(table, least=0.6).collect()}
    assert (got[1].n_links, got[2].n_links, got[3].n_links) == (1, 2, 1) and all(r.component_id == 1 for r in got.values())
    assert embedding_dedup(table.where("false")).collect() == []
    assert [tuple(r) for r in embedding_dedup(table.select(F.lit(4).alias("vec_id"), F.lit(None).cast("array<double>").alias(
        "embedding")).limit(1)).collect()] == [(4, 0, 4, True)]


def test_pivots_lie_apart_and_crowds_come_first():
    rng = np.random.default_rng(4)
    v = unit(clustered(rng, 300, 16, 0.1))
    p = choose_pivots(v, 8, 0.3)
    far = np.arccos(np.clip(p @ p.T, -1, 1)) + np.eye(len(p)) * 9
    assert far.min() > 0.3 and (p[0] @ v.T > 0.95).sum() >= 100


def test_blocks():
    rng = np.random.default_rng(5)
    v = clustered(rng, 90, 4, 0.2)
    times = rng.integers(1, 4, 90)
    cos = unit(v) @ unit(v).T
    link = (cos >= 0.9) & ~np.eye(90, dtype=bool)
    links, root = met(v, None, 0.9, times, None, rows=7)
    assert (links == link @ times).all() and all(root[i] == root[j] for i, j in np.argwhere(link))
    links, _ = met(v[:40], v[40:], 0.9, times[:40], times[40:], rows=7)
    assert (links == np.concatenate([link[:40, 40:] @ times[40:], link[40:, :40] @ times[:40]])).all()
