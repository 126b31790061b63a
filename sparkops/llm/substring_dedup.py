"""Substring deduplication: remove every window of words that occurs elsewhere.

First pass: each partition sketches its windows, and the sketches are merged to
one that overestimates how often a window occurs. A window is sketched by its
minimiser, the smallest hash among its word n-grams, and each position of a
minimiser is counted once: equal windows have equal minimisers at the same
place inside, so a minimiser has at least as many positions as any of its
windows. This needs a tenth of the cells and overestimates only more.

Second pass: the windows estimated repeated, and only these, are grouped
exactly. Consecutive windows of one minimiser form a run, and equal windows lie
at the same place of runs of equal minimisers. So runs are grouped first: all
windows of a run that occurs twice as a whole are repeated. Single windows are
grouped only where a minimiser has different runs, one window list for each of
these and not for each of their copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ._common import (Store, ascii_words, byte_slices, list_array, mix64, rolling,
                      trimmed, window_minima, within, word_hashes)
from .sketch import PARTIAL, merge, partial


SEEDS = (11, 23)


class Windows:
    """The windows of some texts: their places and their minimisers' places."""

    def __init__(self, texts: pa.Array, width: int, gram: int):
        self.counts, self.words = ascii_words(texts)
        self.hashes = word_hashes(self.words, SEEDS[0])
        self.at = within(self.counts, width)  # starts, in the concatenation of all texts
        grams = rolling(self.hashes, gram)
        least = window_minima(grams, width - gram + 1)[self.at]
        # Runs: the place of the minimiser never moves back.
        self.first = np.flatnonzero(np.diff(least, prepend=-1))
        self.size = np.diff(self.first, append=len(least))
        self.keys = grams[least[self.first]]


def span_hashes(first: np.ndarray, last: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of a run from those of its first and last window, which together cover
    it, and its number of windows."""
    return mix64(mix64(first + size.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + last)


def sketches(docs: DataFrame, text_col: str, width: int, gram: int, slice_bytes: int) -> DataFrame:
    @trimmed
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = []
        for b in byte_slices(batches, "text", slice_bytes):
            w = Windows(b.column("text"), width, gram)
            keys.append(w.keys)
            if sum(map(len, keys)) > 4_000_000:
                yield partial(np.concatenate(keys))
                keys = []
        if keys:
            yield partial(np.concatenate(keys))

    return docs.select(F.col(text_col).alias("text")).mapInArrow(make, PARTIAL)


def estimated(docs: DataFrame, repeated, id_col: str, text_col: str, width: int, gram: int,
              slice_bytes: int, keep_text: bool) -> DataFrame:
    """A row per document: number of words, digest of all words, and, if it has
    windows estimated repeated, their runs (start, number of windows, key of the
    minimiser, 128-bit hash) and the words (with ``keep_text``, the words of all)."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    @trimmed
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "text", slice_bytes):
            w = Windows(b.column("text"), width, gram)
            pick = np.flatnonzero(shared.value(w.keys))
            start, size = w.at[w.first[pick]], w.size[pick]
            spans = []
            for seed in SEEDS:
                hashes = rolling(w.hashes if seed == SEEDS[0] else word_hashes(w.words, seed), width)
                spans.append(span_hashes(hashes[start], hashes[start + size - 1], size).view(np.int64))
            ends = np.cumsum(w.counts)
            doc = np.searchsorted(ends, start, side="right")
            per = np.bincount(doc, minlength=b.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), w.words)
            whole = pc.binary_join(lists, " ").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(w.counts.astype(np.int64)),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in whole]),
                 pa.array([t if n or keep_text else None for t, n in zip(whole, per, strict=True)], pa.string()),
                 list_array((start - (ends - w.counts)[doc]).astype(np.int32), per), list_array(size.astype(np.int32), per),
                 list_array(w.keys[pick].view(np.int64), per), *(list_array(h, per) for h in spans)],
                ["id", "n_words", "sha", "words", "start", "size", "key", "h1", "h2"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        find, f"id {kind}, n_words bigint, sha string, words string, start array<int>, size array<int>, "
              "key array<bigint>, h1 array<bigint>, h2 array<bigint>")


def single_windows(texts: DataFrame, width: int) -> DataFrame:
    """(row, pos, w1, w2, once) of every window of the given runs (row, words, runs)."""
    @trimmed
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for from_row in range(0, b.num_rows, 500):
                s = b.slice(from_row, 500)
                counts, words = ascii_words(s.column("words"))
                hashes = [rolling(word_hashes(words, seed), width) for seed in SEEDS]
                runs = s.column("runs")
                per = pc.list_value_length(runs).to_numpy()
                runs = runs.flatten()
                start, size, once = (runs.field(x).to_numpy(zero_copy_only=False) for x in range(3))
                doc = np.repeat(np.arange(s.num_rows), per)
                run = np.repeat(np.arange(len(start)), size)
                pos = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size) + start[run]
                at = pos + (np.cumsum(counts) - counts)[doc[run]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.column("row").to_numpy()[doc[run]]), pa.array(pos.astype(np.int32)),
                     *(pa.array(h[at].view(np.int64)) for h in hashes), pa.array(once[run])],
                    ["row", "pos", "w1", "w2", "once"])

    return texts.select("row", "words", "runs").mapInArrow(
        cut, "row bigint, pos int, w1 bigint, w2 bigint, once boolean")


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 35,
                    gram: int = 8, slice_bytes: int = 8 << 20, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``n_removed`` and ``kept_sha256`` (of
    the kept words, joined by one space; with ``keep_text`` also ``kept``).

    A word is removed if a window of ``width`` words over it starts anywhere else
    too, in the same text or another. Texts that are null, empty or shorter
    than a window lose nothing; whole copies of ``width`` words or more lose all
    words, in every copy. Windows are compared by 128-bit hashes.
    """
    if not 1 <= gram <= width:
        raise ValueError("gram must be between 1 and width")
    store = Store(docs.sparkSession, "op8")
    repeated = merge(store.put(sketches(docs, text_col, width, gram, slice_bytes), "sketch"))
    store.drop("sketch")
    found = store.put(estimated(docs, repeated, id_col, text_col, width, gram, slice_bytes, keep_text)
                      .withColumn("row", F.monotonically_increasing_id()), "runs")
    touched = found.where(F.size("start") > 0)
    runs = touched.select("row", F.explode(F.arrays_zip("start", "size", "key", "h1", "h2")).alias("x")).select("row", "x.*")
    kinds = store.put(runs.groupBy("key", "h1", "h2").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "start", "size")).alias("x")), "kinds")
    whole = runs.join(kinds.where("n > 1").select("key", "h1", "h2"), ["key", "h1", "h2"]).select(
        "row", "start", (F.col("start") + F.col("size") - 1).alias("last"))
    # Where a minimiser has several kinds of runs, and one of them only once.
    mixed = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    some = kinds.join(mixed.select("key"), "key").groupBy("x.row").agg(
        F.collect_list(F.struct("x.start", "x.size", (F.col("n") == 1).alias("once"))).alias("runs"))
    single = store.put(single_windows(touched.select("row", "words").join(some, "row"), width), "single")
    again = single.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    single = single.where("once").join(again, ["w1", "w2"]).select("row", F.col("pos").alias("start"), F.col("pos").alias("last"))
    # Stored, so that the shuffles above are gone before the texts are moved.
    removed = store.put(whole.unionByName(single).groupBy("row").agg(F.collect_list(F.struct("start", "last")).alias("at")),
                        "removed")
    store.drop("kinds", "single")

    @trimmed
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, gone = [], []
            for text, at in zip(b.column("words").to_pylist(), b.column("at"), strict=True):
                words = text.split(" ")
                edge = np.zeros(len(words) + 1, np.int64)
                if at.is_valid:
                    np.add.at(edge, at.values.field(0).to_numpy(), 1)
                    np.add.at(edge, at.values.field(1).to_numpy() + width, -1)
                out = np.cumsum(edge)[:-1] > 0
                kept.append(" ".join(words[i] for i in np.flatnonzero(~out)))
                gone.append(int(out.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("n_words"), pa.array(gone, pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in kept], pa.string()),
                 pa.array(kept if keep_text else [None] * len(kept), pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    # Only texts with windows estimated repeated are joined; all others are done.
    cuts = touched.select("row", "id", "n_words", "words").join(removed, "row", "left").select("id", "n_words", "words", "at").mapInArrow(cut, out)
    rest = found.where(F.size("start") == 0).select("id", "n_words", F.lit(0).cast("bigint").alias("n_removed"),
                                                    F.col("sha").alias("kept_sha256"), F.col("words").alias("kept"))
    done = cuts.unionByName(rest).withColumnRenamed("id", id_col)
    return done if keep_text else done.drop("kept")
