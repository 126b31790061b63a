"""Token counts: the length of every text in tokens, without keeping the ids.

Texts are encoded in Arrow functions that return lengths only. Each Arrow batch
is cut to slices of about ``slice_bytes`` of text, and every text is split at
ASCII white space. That boundary is safe for tokenizers whose rules neither
keep white space nor look across it; the tokenizers of ``.json`` files made of
a white-space-dropping word splitter are such. All others (``.model`` files,
byte-level splitters, whose tokens hold the blank before a word) are encoded as
whole texts.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ._common import byte_slices, trimmed


# Marks that end a run of letters and form one unit with marks next to them (not the
# apostrophe, which may begin a unit with letters).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    """A tokenizer of a worker. ``cache_words`` bounds the memory for the ids of words
    that were met before; the cache starts anew when full."""

    def __init__(self, path: str, cache_words: int = 400_000):
        self.path, self.cache_words, self.cache = path, cache_words, {}
        self.words_apart = False
        if path.endswith(".json"):
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
            from tokenizers import Tokenizer

            self.tok = Tokenizer.from_file(path)
            self.tok.no_truncation()
            self.tok.no_padding()
            self.words_apart = drops_blanks(self.tok)
            self.odd = odd_letters(self.tok) if self.words_apart else set()
            self.lean, self.plain = lean(self.tok, self.odd) if self.words_apart else (None, set())
            mark = getattr(self.tok.model, "end_of_word_suffix", None)
            self.ends = np.zeros(self.tok.get_vocab_size(), bool)
            for token, i in self.tok.get_vocab().items():
                self.ends[i] = bool(mark) and token.endswith(mark)
        else:
            import sentencepiece

            self.tok = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.path.endswith(".json"):
            return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return self.tok.encode(texts, num_threads=1)

    def units(self, words: pa.Array) -> tuple[list[str], np.ndarray]:
        """Distinct units, and the two of each word without white space (places in the
        list). A run of letters is one unit of the splitter, and marks after it are
        another (but for ``odd`` letters), so these are encoded apart; any other word is
        a unit as a whole, and its second one is empty."""
        core = pc.ascii_rtrim(words, characters=MARKS)
        if self.lean is not None:  # both cases of ASCII letters are one unit, in lower case
            core = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core)
        core = core.dictionary_encode()
        cores = core.dictionary.to_pylist()
        apart = np.fromiter(((w.isalpha() and (w.isascii() or self.odd.isdisjoint(w))) for w in cores), bool, len(cores))
        first = core.indices.to_numpy().astype(np.int64)
        left = ~apart[first]
        size = pc.binary_length(words).to_numpy().astype(np.int64)
        marks = size - pc.binary_length(core.dictionary).to_numpy().astype(np.int64)[first]
        marks[left] = 0
        tails = tail_texts(words, marks).dictionary_encode()
        whole = words.filter(pa.array(left)).dictionary_encode()
        first[left] = len(cores) + len(tails.dictionary) + whole.indices.to_numpy()
        second = len(cores) + tails.indices.to_numpy().astype(np.int64)
        units = [w if a else "" for w, a in zip(cores, apart.tolist(), strict=True)]
        return units + tails.dictionary.to_pylist() + whole.dictionary.to_pylist(), np.stack([first, second], axis=1)

    def values(self, units: list[str]) -> list[bytes]:
        """The ids of each unit (32-bit numbers), from the cache where it is known. Runs of
        letters go to the library many at a time, parted by blanks."""
        cache = self.cache
        if len(cache) > self.cache_words:
            cache.clear()
        cache[""] = b""
        out = list(map(cache.get, units))
        new = dict.fromkeys(u for u, v in zip(units, out, strict=True) if v is None)
        if not new:
            return out
        ascii_letters, plain, letters, other = [], [], [], []
        for u in new:
            if not u.isalpha():
                other.append(u)
            elif u.isascii():
                (letters if self.lean is None else ascii_letters).append(u)
            elif self.plain.issuperset(u):
                plain.append(u)
            else:
                (letters if self.odd.isdisjoint(u) else other).append(u)
        if self.lean is not None:
            cache.update(zip(ascii_letters, self.encode_letters(ascii_letters, self.lean[0]), strict=True))
            cache.update(zip(plain, self.encode_letters([u.lower() for u in plain], self.lean[1]), strict=True))
        cache.update(zip(letters, self.encode_letters(letters, self.tok), strict=True))
        for at in range(0, len(other), 20_000):
            part = other[at:at + 20_000]
            cache.update(zip(part, map(id_bytes, self.encode(part)), strict=True))
        return [cache[u] if v is None else v for u, v in zip(units, out, strict=True)]

    def words(self, texts: list[str], made, empty) -> list:
        """``made(ids)`` of each text without white space. For a few texts; ``units`` is
        the way of whole columns."""
        parts = []
        for t in texts:
            core = t.rstrip(MARKS)
            if core.isalpha() and (core.isascii() or self.odd.isdisjoint(core)):
                parts += [core.lower() if core.isascii() and self.lean is not None else core, t[len(core):]]
            else:
                parts += [t, ""]
        each = self.values(parts)
        return [made(np.frombuffer(a + b, np.uint32).tolist()) if t else empty
                for t, a, b in zip(texts, each[::2], each[1::2], strict=True)]

    def encode_letters(self, words: list[str], tok, group: int = 250, groups: int = 80) -> list[bytes]:
        """Ids of runs of letters: every one ends with the only token that ends a unit."""
        out = []
        for at in range(0, len(words), group * groups):
            parts = [words[i:i + group] for i in range(at, min(at + group * groups, len(words)), group)]
            made = tok.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
            for part, m in zip(parts, made, strict=True):
                ids = np.array(m.ids, np.uint32)
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) != len(part):
                    out += map(id_bytes, self.encode(part))
                    continue
                raw, ends = ids.tobytes(), (ends * 4).tolist()
                out += [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        return out


def id_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def tail_texts(words: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The last ``sizes`` bytes of each word."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset + 1:words.offset + 1 + len(words)]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    taken = data[spread(ends - sizes, sizes)]
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(taken))


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places ``start``, ``start + 1``, ... of each run, ``size`` of them."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(start.max(initial=0)) + total) < 2**31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((start - (ends - size)).astype(kind), size)


def drops_blanks(tok) -> bool:
    """Whether white space is never part of a token or of a special token."""
    made = json.loads(tok.to_str())
    split = made.get("pre_tokenizer") or {}
    parts = split.get("pretokenizers", [split])
    first = parts[0] if parts else {}
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") \
        and r"\s" in first["pattern"].get("Regex", "") and not any(p.get("add_prefix_space") for p in parts)
    return bool(drops) and not any(c.isspace() for a in made["added_tokens"] for c in a["content"])


def odd_letters(tok) -> set[str]:
    """Letters that the tokenizer's normaliser and splitter don't leave inside a run of
    letters: their normal form holds a mark, say, which goes with the marks after it."""
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()]
    # Each between two plain letters and before a mark: two units, or it is odd.
    words = [f"a{c}a." for c in letters]
    if tok.normalizer is not None:
        forms = tok.normalizer.normalize_str(" ".join(words)).split(" ")
        if len(forms) != len(words):
            return {c for c in letters if not c.isascii()}
        words = forms
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [start for piece, (start, _) in tok.pre_tokenizer.pre_tokenize_str(" ".join(words)) if piece.strip()]
    units = np.bincount(np.searchsorted(ends, starts, side="right"), minlength=len(words))
    return {c for c, n in zip(letters, units.tolist(), strict=True) if n != 2}


def lean(tok, odd: set[str]) -> tuple[tuple | None, set[str]]:
    """The tokenizer without its normaliser, for units of ASCII letters and for others, and
    the letters of which the normaliser only makes the lower case; none if either case of
    an ASCII letter isn't among them."""
    from tokenizers import Tokenizer, pre_tokenizers

    made = json.loads(tok.to_str())
    norm = made["normalizer"] or {}
    norm = norm.get("normalizers", [norm] if norm else [])
    split = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
    # These change a letter whatever stands beside it, but for marks (and letters from
    # U+1100 on) that NFC joins with it.
    known = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} for n in norm)
    bytewise = [p["type"] for p in split] == ["Split", "ByteLevel"] and not split[1]["use_regex"]
    if not (known and bytewise and norm):
        return None, set()
    letters = [c for c in map(chr, range(0x590)) if c.isalpha() and c not in odd]
    forms = tok.normalizer.normalize_str(" ".join(letters)).split(" ")
    if len(forms) != len(letters):
        return None, set()
    # Not the sigma, whose lower case depends on its place in Python.
    plain = {c for c, form in zip(letters, forms, strict=True) if form == c.lower() and ("a" + c).lower() == "a" + form and len(form) == 1}
    if not plain.issuperset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        return None, set()
    by_blank = pre_tokenizers.WhitespaceSplit()
    of_ascii, of_all = Tokenizer(tok.model), Tokenizer(tok.model)
    of_ascii.pre_tokenizer = by_blank  # an ASCII letter is its own byte
    of_all.pre_tokenizer = pre_tokenizers.Sequence(
        [by_blank, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return (of_ascii, of_all), plain


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, read once per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def text_lengths(enc: Encoder, texts: pa.Array) -> np.ndarray:
    """Tokens of each text (no nulls)."""
    if not enc.words_apart:
        return np.fromiter(map(len, enc.encode(texts.to_pylist())), np.int64, len(texts))
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    units, places = enc.units(coded.dictionary)
    each = (np.fromiter(map(len, enc.values(units)), np.int64, len(units)) // 4)[places].sum(axis=1)
    sums = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
    return np.diff(sums[lists.offsets.to_numpy()])


def token_counts(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, slice_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``docs``: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (``n_tokens > limit``).

    A null text counts as empty: 0 bytes, 0 tokens. Null and repeated ids pass
    through, a row each. Only the two columns are read, so further columns,
    also of clashing names, don't matter. An empty table gives no rows.
    """
    @trimmed
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in byte_slices(batches, "text", slice_bytes):
            texts = pc.fill_null(b.column("text"), "")
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(text_lengths(enc, texts))],
                ["id", "n_bytes", "n_tokens"])
        enc.cache.clear()

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (read.mapInArrow(lengths, f"id {kind}, n_bytes bigint, n_tokens bigint")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
