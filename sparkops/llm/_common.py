"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sparkops.session import scratch_path


def workers_import(spark) -> None:
    """Let Python workers on this machine import this package, wherever the driver
    was started. (On a cluster the package is installed or sent by --py-files.)"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


BATCH_ROWS, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark, rows: int = 1000, size: int = 8 << 20) -> None:
    """Let the session send texts to Python in batches of at most ``rows`` rows (a smaller
    number that it has stays): a batch is held several times over outside the heap of the
    JVM and in the worker, for each task of an executor."""
    for key, most in ((BATCH_ROWS, rows), (BATCH_BYTES, size)):
        has = spark.conf.get(key, None)  # None: as it comes with Spark
        if has is None or (has.lstrip("-").isdigit() and not 0 < int(has) <= most):
            spark.conf.set(key, str(most))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write ``df`` once. The shuffle files of the write go with it: without this setting
    they stay until the driver's JVM happens to collect what they belong to."""
    conf = df.sparkSession.conf
    old = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if old is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, old)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a fresh table below the shared checkpoint folder and read
    it back: lineage is cut, and any executor can read any part again."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


class Store:
    """Tables that one operator writes below the shared checkpoint folder, and drops
    as soon as nothing that is still to run reads them."""

    def __init__(self, spark, tag: str):
        self.spark, self.tag, self.paths = spark, tag, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """``stored``, under a name."""
        path = scratch_path(self.spark, f"{self.tag}-{name}")
        write_table(df, path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove the tables of these names, through the file system of their path."""
        for name in names:
            for path in self.paths.pop(name, []):
                at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def sized(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``most_rows`` rows, of a few
    numbers or short words each; beyond that Spark joins by shuffling. ``df`` is a
    stored table, cheap to count."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def byte_slices(batches: Iterator[pa.RecordBatch], column: str | int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds about ``max_bytes`` of
    ``column`` (a single longer row is a slice of its own; texts stay whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def trimmed(work):
    """A function over Arrow batches that, when it has ended, gives the memory it
    has freed back to the system: Spark keeps its Python workers for later tasks."""
    @functools.wraps(work)
    def run(batches):
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none): the number per
    text and all words in order."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    keep = pc.greater(pc.binary_length(words), 0)
    counts = np.bincount(owner[keep.to_numpy(zero_copy_only=False)], minlength=len(lists))
    return counts, words.filter(keep)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array, seed: int) -> np.ndarray:
    """64-bit hashes of words; each distinct word of the batch is hashed once."""
    import xxhash

    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    each = np.fromiter((digest(w, seed) for w in coded.dictionary.to_pylist()), np.uint64,
                       len(coded.dictionary))
    return each[coded.indices.to_numpy()]


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive items (order counts); item ``i`` of the
    result covers ``i .. i+width-1``. Doubles the covered span at each step, so
    the cost is log(width) passes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, have, power, span, left = None, 0, hashes, 1, width
    odd = np.uint64(0x9E3779B97F4A7C15)
    while left:
        if left & 1:
            part = power[have:have + n]
            out = part if out is None else mix64(out * odd + part)
            have += span
        left >>= 1
        if left:
            power = mix64(power[:-span] * odd + power[span:])
            span *= 2
    return out


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (the first of equal ones) among each ``width``
    consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        span += step
    return best[:n]


def within(counts: np.ndarray, width: int) -> np.ndarray:
    """Indices, in the concatenation of sequences of the given lengths, where a
    window of ``width`` items fits into its own sequence."""
    starts = np.cumsum(counts) - counts
    fit = np.maximum(counts - width + 1, 0)
    total = int(fit.sum())
    shift = np.repeat(starts - (np.cumsum(fit) - fit), fit)
    return np.arange(total) + shift


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
