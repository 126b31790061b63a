"""Count-min sketches over 64-bit keys, made per partition and merged.

A partition's sketch is sparse: the cells it met, and which of them it met more
than once. Merging adds cells up to the count 2, which is all that "met more
than once" needs, so the merged sketch is a bitmap per hash row. Its width
follows the number of keys up to ``max_cells``, so it has a fixed bound; a
fuller sketch only estimates more keys as repeated, and never misses one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Tuple  # noqa: UP035  (Spark reads this hint)

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._common import mix64

DEPTH, SHARD_BITS = 2, 6
PARTIAL = "hash_row int, shard int, n bigint, cells binary, again binary"


def cells_of(keys: np.ndarray, hash_row: int) -> np.ndarray:
    """32-bit cells; the merged sketch keeps their leading bits."""
    return (mix64(keys + np.uint64(0x9E3779B97F4A7C15 * (hash_row + 1) % 2**64)) >> np.uint64(32)).astype(np.uint32)


def partial(keys: np.ndarray) -> pa.RecordBatch:
    """The sparse sketch of some keys, as rows by hash row and range of cells."""
    rows = []
    for d in range(DEPTH):
        cells, counts = np.unique(cells_of(keys, d), return_counts=True)
        edges = np.searchsorted(cells, np.arange(1, 1 << SHARD_BITS, dtype=np.uint64) << np.uint64(32 - SHARD_BITS))
        for shard, (c, n) in enumerate(zip(np.split(cells, edges), np.split(counts, edges), strict=True)):
            if len(c):
                rows.append({"hash_row": d, "shard": shard, "n": len(c), "cells": c.tobytes(),
                             "again": np.packbits(n > 1).tobytes()})
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("hash_row", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("cells", pa.binary()),
        ("again", pa.binary())]))


class Repeated:
    """The merged sketch."""

    def __init__(self, bits: np.ndarray, width: int):
        self.bits, self.width = bits, width  # [DEPTH, 2**width / 8]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key is estimated to occur at least twice."""
        out = np.ones(len(keys), bool)
        for d in range(DEPTH):
            cell = cells_of(keys, d) >> np.uint32(32 - self.width)
            out &= (self.bits[d][cell >> np.uint32(3)] >> (np.uint8(7) - (cell & np.uint32(7)).astype(np.uint8))) & 1 == 1
        return out


def merge(partials: DataFrame, load: int = 4, max_cells: int = 1 << 29) -> Repeated:
    """Merge stored partial sketches (rows of ``PARTIAL``). Each merging task holds
    one range of cells, whatever the number of partitions; the driver gets
    ``DEPTH * max_cells / 8`` bytes at most."""
    most = partials.groupBy("hash_row").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 1
    width = max(16, min(max_cells.bit_length() - 1, int(load * most - 1).bit_length()))
    size = 1 << (width - SHARD_BITS)

    def add(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # noqa: UP006
        count = np.zeros(size, np.uint8)
        for b in batches:
            for cells, again in zip(b.column("cells"), b.column("again"), strict=True):
                c = np.frombuffer(cells.as_buffer(), np.uint32) >> np.uint32(32 - width)
                c = c & np.uint32(size - 1)
                twice = np.unpackbits(np.frombuffer(again.as_buffer(), np.uint8), count=len(c)).astype(bool)
                twice[1:] |= c[1:] == c[:-1]  # cells are sorted; narrower ones may meet
                count[c[twice]] = 2
                count[c] = np.minimum(count[c] + 1, 2)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                                          pa.array([np.packbits(count == 2).tobytes()])], ["hash_row", "shard", "bits"])

    bits = np.zeros((DEPTH, 1 << SHARD_BITS, size // 8), np.uint8)
    for r in partials.groupBy("hash_row", "shard").applyInArrow(add, "hash_row int, shard int, bits binary").collect():
        bits[r.hash_row, r.shard] = np.frombuffer(r.bits, np.uint8)
    return Repeated(bits.reshape(DEPTH, -1), width)
