"""Alignment of two tokenizers' tokens by the bytes where they end.

Tokenizer A is a byte-level one (a ``.json`` file), B a piece model that puts a blank
before the text (a ``.model`` file). Both split the same bytes, a space and the text,
so their tokens are two sorted lists of end offsets. These are merged in lockstep:
one state vector holds a pointer into the A tokens and one into the B tokens of every
document of a batch, and a step moves, in all documents at once, the pointer whose
token ends first; where both end together it moves both, emits the two tokens as a
link and cuts a group there. Documents that are through are taken out of the vector.

Texts are cut into units at each space between two characters that are no white space:
there A starts a new word, and B, if none of its pieces has a blank after another
character (checked on the vocabulary), can't join across. A unit is encoded with its
space before it, as in the whole text, and each distinct unit of a batch once. So that
one long document doesn't keep the state vector nearly empty, its lanes are runs of
``lane_units`` units.

Counts of linked id pairs are summed in Spark over all documents.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sparkops.operators.joins import salted_join

from ._common import Store, byte_slices, list_array, trimmed


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible
    Latin-1 characters for themselves, the others, in order, from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


class Ragged(NamedTuple):
    """Lists as their lengths and all their items."""

    counts: np.ndarray
    items: np.ndarray


def ragged(lists: list[list[int]]) -> Ragged:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return Ragged(counts, np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())))


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs starts, and where the last one stops."""
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


class Tokenizers:
    """The two tokenizers of a worker, with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = byte_of_char()
        vocab = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        size = max(vocab) + 1
        bytes_a = [bytes(byte[c] for c in vocab[i]) if i in vocab and all(c in byte for c in vocab[i])
                   else vocab.get(i, "").encode() for i in range(size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.large_binary()), pa.array(bytes_b, pa.large_binary())
        self.width_a, self.width_b = (np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b))
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        # Texts of the ids: an A id followed by "," or, at a cut, "|"; a B id by "," or ";".
        self.said = pa.array([f"{i}{end}" for n, ends in ((size, ",|"), (len(pieces), ",;")) for i in range(n) for end in ends],
                             pa.large_string())
        self.first_b = 2 * size

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Per text the number of its units, and these in order as places in a list of
        different strings. An empty text has none."""
        parts = pc.split_pattern(texts, " ") if self.cuts else pa.array([[t] for t in texts.to_pylist()], pa.list_(pa.string()))
        coded = parts.flatten().dictionary_encode()
        words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        starts, ends = (np.array([w != "" and not w[k].isspace() for w in words], bool) for k in (0, -1))
        new = np.ones(len(code), bool)
        new[1:] = ends[code[:-1]] & starts[code[1:]]
        border = starts_of(np.diff(parts.offsets.to_numpy()))
        new[border[:-1]] = True
        first = np.flatnonzero(new)
        stop = np.append(first[1:], len(code))
        unit = code[first].astype(np.int64)
        glued: dict[str, int] = {}
        for k in np.flatnonzero(stop - first > 1):
            whole = " ".join(words[c] for c in code[first[k]:stop[k]])
            unit[k] = len(words) + glued.setdefault(whole, len(glued))
        words += glued
        some = np.array([w != "" for w in words], bool)[unit]
        text = np.searchsorted(border, first, side="right") - 1
        return np.bincount(text[some], minlength=len(texts)), unit[some], words

    def encode(self, units: list[str], group: int = 200) -> tuple[Ragged, Ragged]:
        """Per tokenizer the ids of each unit. Units go to the library many at a time, parted
        by the blanks that start them; those that start or end with white space, or stand
        in a group of other bytes than its text's, alone."""
        plain = np.array([not u[0].isspace() and not u[-1].isspace() for u in units], bool) & self.cuts
        some = np.flatnonzero(plain)
        texts = [" ".join([units[k] for k in some[at:at + group]]) for at in range(0, len(some), group)]
        widths = np.array([len(units[k].encode()) + 1 for k in some], np.int64)
        out = []
        for library, words in ((self.ids_a, self.bytes_a), (self.ids_b, self.bytes_b)):
            made = ragged(library(texts))
            data, at = joined(made.items, words)
            right = [b" " + t.encode() == bytes(data[x:y]) for t, (x, y) in zip(texts, pairwise(at[starts_of(made.counts)]))]
            apart = np.append(np.flatnonzero(~plain), some[np.repeat(~np.array(right, bool), group)[:len(some)]])
            # Tokens of the groups that are right, by unit: a unit stops where a token does.
            kept = np.repeat(np.array(right, bool), made.counts)
            whole = some[np.repeat(np.array(right, bool), group)[:len(some)]]
            stops = starts_of(widths[np.searchsorted(some, whole)])
            ends = starts_of(np.diff(at)[kept])
            counts = np.zeros(len(units), np.int64)
            counts[whole] = np.diff(np.searchsorted(ends, stops))
            alone = ragged(library([units[k] for k in apart]))
            counts[apart] = alone.counts
            place = np.concatenate([np.repeat(whole, counts[whole]), np.repeat(apart, alone.counts)])
            items = np.concatenate([made.items[kept], alone.items])
            out.append(Ragged(counts, items[np.argsort(place, kind="stable")]))
        return tuple(out)

    def ids_a(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]

    def ids_b(self, units: list[str]) -> list[list[int]]:
        return self.b.encode(units, num_threads=1)


@functools.lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def joined(ids: np.ndarray, words: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The words of all ids, one after another, and where each starts."""
    taken = words.take(pa.array(ids))
    _, offsets, data = taken.buffers()
    at = np.frombuffer(offsets, np.int64, len(taken) + 1 + taken.offset)[taken.offset:]
    return memoryview(data) if data is not None else memoryview(b""), at


def ends_of(widths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """End offset of each token inside its lane."""
    total = np.cumsum(widths)
    before = np.concatenate([[0], total])[starts_of(counts)[:-1]]
    return total - np.repeat(before, counts)


def lockstep(ends_a: np.ndarray, counts_a: np.ndarray, ends_b: np.ndarray, counts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each A token, and each B token, ends where a token of the other ends.
    Both tokens of a lane end at the same last offset; lanes have tokens."""
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    sa, sb = starts_of(counts_a), starts_of(counts_b)
    state = np.stack([sa[:-1], sb[:-1], sa[1:]])  # pointers into A and B, and the stop of A
    while state.shape[1]:
        a, b, stop = state
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        state[0] += end_a <= end_b
        state[1] += end_b <= end_a
        through = state[0] == stop
        if through.any():
            state = state[:, ~through]
    return cut_a, cut_b


def runs(counts: np.ndarray, size: int) -> np.ndarray:
    """Lengths of the runs of at most ``size`` into which sequences of these lengths fall."""
    number = -(-counts // size)
    out = np.full(number.sum(), size)
    some = counts > 0
    out[np.cumsum(number)[some] - 1] = (counts[some] - 1) % size + 1
    return out


def spread(lists: Ragged, at: np.ndarray) -> Ragged:
    """The lists at these places."""
    counts = lists.counts[at]
    shift = starts_of(lists.counts)[at] - starts_of(counts)[:-1]
    return Ragged(counts, lists.items[np.arange(counts.sum()) + np.repeat(shift, counts)])


def align(tok: Tokenizers, texts: pa.Array, lane_units: int) -> dict[str, np.ndarray]:
    """Of all texts, one after another: ``n_a`` and ``n_b`` tokens (zero where the bytes of
    either tokenizer differ from the text's), ids ``a`` and ``b``, and their cuts."""
    per, unit, words = tok.units(texts)
    used, unit = np.unique(unit, return_inverse=True)
    made, docs = {}, starts_of(per)
    same = np.array([t != "" for t in texts.to_pylist()], bool)
    raw = [b" " + t.encode() for t in texts.to_pylist()]
    for x, lists, bytes_of in zip("ab", tok.encode([words[k] for k in used]), (tok.bytes_a, tok.bytes_b), strict=True):
        counts, ids = made[x] = spread(lists, unit)
        data, at = joined(ids, bytes_of)
        border = at[starts_of(counts)[docs]].tolist()
        for k in np.flatnonzero(same):
            same[k] = raw[k] == bytes(data[border[k]:border[k + 1]])
    unit_same, out, lanes = np.repeat(same, per), {}, {}
    per = np.where(same, per, 0)
    lane = starts_of(runs(per, lane_units))
    for x, width in (("a", tok.width_a), ("b", tok.width_b)):
        counts, ids = made[x]
        out[x] = ids[np.repeat(unit_same, counts)]
        tokens = starts_of(counts[unit_same])
        out["n_" + x] = np.diff(tokens[starts_of(per)])
        lanes[x] = np.diff(tokens[lane])
        lanes["ends_" + x] = ends_of(width[out[x]], lanes[x])
    out["cut_a"], out["cut_b"] = lockstep(lanes["ends_a"], lanes["a"], lanes["ends_b"], lanes["b"])
    return out


def digests(tok: Tokenizers, made: dict[str, np.ndarray]) -> list[str]:
    """Hash of each text's groups, as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    cut_a, cut_b, n = made["cut_a"], made["cut_b"], len(made["a"]) + len(made["b"])
    stops_a, stops_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    codes = np.empty(n, np.int64)
    # Before an A token stand all B tokens of earlier groups; before a B token all A tokens of its own, too.
    codes[np.arange(len(cut_a)) + np.concatenate([[0], stops_b])[group_a]] = 2 * made["a"] + cut_a
    codes[np.arange(len(cut_b)) + (stops_a[group_b] if len(stops_a) else 0)] = tok.first_b + 2 * made["b"] + cut_b
    data, at = joined(codes, tok.said)
    borders = at[starts_of(made["n_a"] + made["n_b"])].tolist()
    return [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(borders[:-1], borders[1:], strict=True)]


def link_counts(made: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of each text; and for each text its distinct linked pairs (``a * 2**32 + b``):
    their number, the pairs and how often each occurs."""
    n, size_b = len(made["n_a"]), int(made["b"].max(initial=0)) + 1
    size = (int(made["a"].max(initial=0)) + 1) * size_b
    if n * size >= 1 << 63:
        raise ValueError("too many rows in one batch for vocabularies of this size")
    doc = np.repeat(np.arange(n), made["n_a"])[made["cut_a"]]
    key = np.sort(doc * size + made["a"][made["cut_a"]] * size_b + made["b"][made["cut_b"]])
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    times = np.diff(np.append(first, len(key)))
    code = key[first] % size
    return (np.bincount(doc, minlength=n), np.bincount(key[first] // size, minlength=n),
            (code // size_b << 32) + code % size_b, times)


def alignments(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text",
               slice_bytes: int = 2 << 20, lane_units: int = 256) -> DataFrame:
    """Per row of ``docs``: the id, the token ids ``a`` and ``b``, and for each of the links, in
    order, the tokens' places ``link_a`` and ``link_b`` (from 0); the groups lie between links.
    For texts that have no tokens (see ``token_alignment``) the lists are empty."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(path_a, path_b)
        for batch in byte_slices(batches, "text", slice_bytes):
            m = align(tok, pc.fill_null(batch.column("text"), ""), lane_units)
            n_links = link_counts(m)[0]
            place = {x: np.arange(len(m[x])) - np.repeat(starts_of(m["n_" + x])[:-1], m["n_" + x]) for x in "ab"}
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), list_array(m["a"], m["n_a"]), list_array(m["b"], m["n_b"]),
                 list_array(place["a"][m["cut_a"]], n_links), list_array(place["b"][m["cut_b"]], n_links)],
                ["id", "a", "b", "link_a", "link_b"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, a array<bigint>, b array<bigint>, link_a array<bigint>, link_b array<bigint>")
            .withColumnRenamed("id", id_col))


def token_alignment(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text",
                    slice_bytes: int = 2 << 20, lane_units: int = 256, most_pairs: int = 500_000) -> DataFrame:
    """Per row of ``docs``: the id, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``,
    ``groups_sha256``, ``n_best`` (links whose pair is linked as often, over all rows, as any
    pair of its B id) and ``count_sum`` (how often, over all rows, the links' pairs are linked).

    Texts that are null or empty, or whose tokens' bytes don't give a space and the text,
    have no tokens: zeros and an empty text in place of the hash. Rows that repeat are
    counted each; null ids pass through. The counts of up to ``most_pairs`` id pairs are
    broadcast; beyond that they are joined by a shuffle that splits frequent pairs. Only the
    two columns are read. An empty table has no rows.
    """
    store = Store(docs.sparkSession, "op13")

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(path_a, path_b)
        for batch in byte_slices(batches, "text", slice_bytes):
            m = align(tok, pc.fill_null(batch.column("text"), ""), lane_units)
            n_links, n_pairs, codes, times = link_counts(m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), *(pa.array(x) for x in (m["n_a"], m["n_b"], n_links)), pa.array(digests(tok, m), pa.string()),
                 list_array(codes, n_pairs), list_array(times, n_pairs)],
                ["row", "id", "n_a", "n_b", "n_links", "groups_sha256", "codes", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    made = store.put(read.mapInArrow(
        run, f"row bigint, id {kind}, n_a bigint, n_b bigint, n_links bigint, groups_sha256 string, codes array<bigint>, "
        "times array<bigint>"), "rows")
    each = made.select("row", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("row", "x.codes", "x.times")
    counts = store.put(each.groupBy("codes").agg(F.sum("times").alias("count")), "counts")
    b_id = F.col("codes").bitwiseAND(F.lit((1 << 32) - 1))
    tops = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("top"))
    counts = store.put(counts.withColumn("b_id", b_id).join(tops, "b_id").select(
        "codes", "count", (F.col("count") == F.col("top")).alias("best")), "pairs")
    store.drop("counts")
    if counts.limit(most_pairs + 1).count() <= most_pairs:
        told = each.join(F.broadcast(counts), "codes")
    else:
        told = salted_join(each, counts, "codes", "row")
    sums = told.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return made.drop("codes", "times").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
