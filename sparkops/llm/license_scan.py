"""License scan: winnowed fingerprints, an inverted index, banded alignment.

The templates' word n-grams are winnowed, and the fingerprints go to an inverted
index (sorted hashes with template and place). A text's fingerprints that occur
in the index pick (text, template, diagonal) candidates; around each candidate
diagonal a banded sequence alignment of the template with the text finds how
many template words are matched in order, and where. The words that tell
licenses apart (names and versions) must be the template's, with none missing,
changed or added between.

The templates are a fixed list of a few kilobytes, so the index goes to every
task; the corpus is scanned once, whole texts, without a shuffle.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ._common import ascii_words, byte_slices, rolling, trimmed, window_minima, within

# Wordings of license grants and notices, as published.
_MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_GNU_HEAD = """This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}
General Public License as published by the Free Software Foundation, either version {3} of the License, or (at your
option) any later version."""
_GNU_LINE = "This work is licensed under the GNU {0} General Public License, version {1}."
TEMPLATES = {
    "AGPL-3.0": [_GNU_LINE.format("Affero", "3"), _GNU_HEAD.format("program", ":", "Affero", "3")],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at""",
    ],
    "BSD": ["Released under the BSD License."],  # which of them isn't said
    "BSD-2-Clause": [_BSD_HEAD],
    "BSD-3-Clause": [_BSD_HEAD + """ Neither the name of the copyright holder nor the names of its contributors may
        be used to endorse or promote products derived from this software without specific prior written permission."""],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", """This work is licensed under a Creative Commons
        Attribution-NonCommercial 4.0 International License."""],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", """This work is licensed under a Creative Commons
        Attribution-ShareAlike 4.0 International License."""],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                _GNU_HEAD.format("program", ";", "", "2")],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
                General Public License as published by the Free Software Foundation, either version 3 of the License,
                or (at your option) any later version."""],
    "ISC": ["""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""],
    "LGPL-2.0": [_GNU_LINE.format("Library", "2"), _GNU_HEAD.format("library", ";", "Library", "2")],
    "LGPL-2.1": [_GNU_LINE.format("Lesser", "2.1"), _GNU_HEAD.format("library", ";", "Lesser", "2.1")],
    "LGPL-3.0": [_GNU_LINE.format("Lesser", "3"), _GNU_HEAD.format("program", ":", "Lesser", "3")],
    "MIT": ["Released under the MIT License.", _MIT_BODY],
    "MPL-2.0": ["""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at"""],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# Creative Commons: the short and the long names of the other kinds and versions.
for _short, _long in (("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-ND", "-NoDerivatives"), ("BY-NC", "-NonCommercial"),
                      ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives")):
    for _version, _where in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        _form = _long if _version == "4.0" else _long.replace("NoDerivatives", "NoDerivs")
        TEMPLATES.setdefault(f"CC-{_short}-{_version}", [
            f"Licensed under CC {_short} {_version}.",
            f"This work is licensed under a Creative Commons Attribution{_form} {_version} {_where} License."])
# Words that tell licenses apart, besides versions.
NAMES = ["affero", "apache", "artistic", "boost", "bsd", "cc", "cddl", "eclipse", "epl", "expat", "gnu", "isc", "lesser",
         "mit", "mozilla", "mpl", "x11", "zlib"]
_CC_WORDS = ["noncommercial", "noderivatives", "noderivs", "sharealike"]
# End of the fixed values.

EDGE = "!\"#$%&'()*,-./:;<=>?@[\\]^_`{|}~"


def plain(word: str) -> str:
    """A word without marks at its ends, A-Z lower-cased."""
    return word.strip(EDGE).translate(_LOWER)


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def telling_words() -> dict[int, str]:
    """Hash of a plain word to the name or version it stands for."""
    names = {x: x for x in [*NAMES, *_CC_WORDS]}
    names |= {x: x for k in range(4) for p in itertools.permutations(_CC_WORDS, k) for x in ["-".join(("attribution", *p))]}
    names |= {x: x for k in range(3) for p in itertools.permutations(("nc", "nd", "sa"), k) for x in ["-".join(("by", *p))]}
    for a in range(21):
        for v in ("", "v"):
            names |= {f"{v}{a}": str(a)} | {f"{v}{a}.{b}": f"{a}.{b}" if b else str(a) for b in range(10)}
    return {xxhash.xxh3_64_intdigest(k): x for k, x in names.items()}


def plain_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of plain words (0: nothing but marks)."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    each = np.fromiter((xxhash.xxh3_64_intdigest(p) if (p := plain(w)) else 0 for w in coded.dictionary.to_pylist()),
                       np.uint64, len(coded.dictionary))
    return each[coded.indices.to_numpy()]


def without_marks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and the hashes of all, mark-only words left out."""
    counts, words = ascii_words(texts)
    hashes = plain_hashes(words)
    owner = np.repeat(np.arange(len(counts)), counts)
    return np.bincount(owner[hashes != 0], minlength=len(counts)), hashes[hashes != 0]


def winnow(counts: np.ndarray, hashes: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the concatenation) and values of the fingerprints: the smallest
    n-gram hash of every ``window`` consecutive ones of a text, or of all if it
    has fewer. Runs of ``gram + window - 1`` shared words share one at least."""
    grams = rolling(hashes, gram)
    places = [window_minima(grams, window)[within(counts, gram + window - 1)]]
    starts = np.cumsum(counts) - counts
    for n in range(gram, gram + window - 1):
        for s in starts[counts == n]:
            places.append(np.array([s + int(np.argmin(grams[s:s + n - gram + 1]))]))
    places = np.unique(np.concatenate(places)).astype(np.int64)
    return places, grams[places] if len(places) else grams[:0]


class Index:
    """Sorted fingerprints of the templates with template number and place."""

    def __init__(self, templates: dict[str, list[str]], gram: int, window: int):
        self.gram, self.window = gram, window
        self.names = [name for name in sorted(templates) for _ in templates[name]]
        wordings = [text for name in sorted(templates) for text in templates[name]]
        self.counts, hashes = without_marks(pa.array(wordings, pa.string()))
        if (self.counts < gram).any():
            raise ValueError(f"a template has fewer than {gram} words")
        ends = np.cumsum(self.counts)
        self.words = np.split(hashes, ends[:-1])
        self.telling = telling_words()
        self.wanted = [[x for w in words.tolist() if (x := self.telling.get(w))] for words in self.words]
        # All n-grams of the templates, so that each fingerprint of a text meets its like.
        at = within(self.counts, gram)
        of = np.searchsorted(ends, at, side="right")
        keys = rolling(hashes, gram)[at]
        by = np.argsort(keys, kind="stable")
        self.keys, self.of, self.at = keys[by], of[by], (at - (ends - self.counts)[of])[by]

    def told(self, t: int, words: np.ndarray) -> bool:
        """Are the names and versions among the words matched the template's? Versions
        count for templates that have one, ``by`` for those of ``cc``; bodies
        without a name may hold any."""
        wanted = self.wanted[t]
        versions, by = any(x[0].isdigit() for x in wanted), "cc" in wanted

        def counting(found: list[str]) -> list[str]:
            return [x for x in found if (versions or not x[0].isdigit()) and (by or x != "by")]

        wanted = counting(wanted)
        return not wanted or counting([x for w in words.tolist() if (x := self.telling.get(w))]) == wanted

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into keys, template, place) of every posting met."""
        a, b = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, side="right")
        n = b - a
        k = np.repeat(np.arange(len(keys)), n)
        p = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + a[k]
        return k, self.of[p], self.at[p]


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Most template words matched in order within ``band`` of the diagonal (text
    place minus template place), by the longest common subsequence; and the
    first and last text word matched, of the shortest such span from the right."""
    width = 2 * band + 1
    score, start, stop = [0] * (width + 1), [-1] * (width + 1), [-1] * (width + 1)
    n = len(text)
    for i, t in enumerate(template.tolist()):
        # Cell j is the text place i + diagonal - band + j; above is cell j + 1 of the row before.
        new, new_start, new_stop = [0] * (width + 1), [-1] * (width + 1), [-1] * (width + 1)
        for j in range(width):
            at = i + diagonal - band + j
            s, a, b = score[j + 1], start[j + 1], stop[j + 1]
            if j and new[j - 1] > s:
                s, a, b = new[j - 1], new_start[j - 1], new_stop[j - 1]
            if 0 <= at < n and text[at] == t:
                if score[j] + 1 > s or score[j] + 1 == s and (start[j] if start[j] >= 0 else at) > a:
                    s, a, b = score[j] + 1, start[j] if start[j] >= 0 else at, at
            new[j], new_start[j], new_stop[j] = s, a, b
        score, start, stop = new, new_start, new_stop
    best = max(range(width), key=lambda j: (score[j], start[j]))
    return score[best], start[best], stop[best]


def license_matches(hashes: np.ndarray, fingerprints: list[tuple[int, int, int]], index: Index,
                    least: float) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first word, last word) in one text, from its index
    hits (template, place in template, place in text); of matches of one template
    that overlap, the best."""
    lines = defaultdict(list)
    for t, a, b in fingerprints:
        lines[t].append(b - a)
    out = []
    for t, diagonals in lines.items():
        words = index.words[t]
        band = max(2, len(words) // 8)
        found, last = [], None
        for d in sorted(set(diagonals)):
            if last is not None and d - last <= band:
                continue  # inside the band around the diagonal before
            last = d
            n, a, b = align(words, hashes, d, band)
            if n >= least * len(words) and index.told(t, hashes[a:b + 1]):
                found.append((n, a, b))
        free = []
        for n, a, b in sorted(found, key=lambda x: (-x[0], x[1])):
            if all(b < c or a > e for _, c, e in free):
                free.append((n, a, b))
        out += [(t, n, a, b) for n, a, b in free]
    return out


def strongest(found: list[tuple[int, int, int, int]], index: Index) -> list[tuple[str, float, int, int]]:
    """(license, coverage, first, last): where spans overlap the one of more matched
    words stays, then of higher coverage, then the first name."""
    ranked = sorted(found, key=lambda x: (-x[1], -x[1] / index.counts[x[0]], index.names[x[0]], x[2]))
    out: list[tuple[str, float, int, int]] = []
    for t, n, a, b in ranked:
        if all(b < c or a > e for _, _, c, e in out):
            out.append((index.names[t], n / int(index.counts[t]), a, b))
    return sorted(out, key=lambda x: x[2])


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, list[str]] | None = None, gram: int = 3, window: int = 3, least: float = 0.8,
                 slice_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``docs``: the id, ``n_matches``, ``licenses`` (names, distinct, by
    name, comma-joined), ``spans`` (license:start:end in code points, end
    exclusive, by start) and ``coverage`` (the largest share of a template's words
    that was matched; 0 without a match).

    A match has ``least`` or more of a template's words in order, and the names and
    versions in its span are the template's (``Index.told``). Every run of
    ``gram + window - 1`` words shared with a template makes a candidate. Null,
    empty and wordless texts match nothing; repeated rows give repeated results.
    """
    index = Index(templates or TEMPLATES, gram, window)

    @trimmed
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "text", slice_bytes):
            texts = b.column("text")
            counts, hashes = without_marks(texts)
            places, keys = winnow(counts, hashes, gram, window)
            k, t, a = index.hits(keys)
            ends = np.cumsum(counts)
            doc = np.searchsorted(ends, places[k], side="right")
            hits = defaultdict(list)
            for d, *hit in zip(doc.tolist(), t.tolist(), a.tolist(), (places[k] - (ends - counts)[doc]).tolist(), strict=True):
                hits[d].append(tuple(hit))
            n, names, spans, cover = [0] * b.num_rows, [""] * b.num_rows, [""] * b.num_rows, [0.0] * b.num_rows
            for d, found in hits.items():
                matched = strongest(license_matches(hashes[ends[d] - counts[d]:ends[d]], found, index, least), index)
                if not matched:
                    continue
                at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[d].as_py()) if plain(m[0])]
                n[d], cover[d] = len(matched), max(c for _, c, _, _ in matched)
                names[d] = ",".join(sorted({name for name, *_ in matched}))
                spans[d] = ",".join(f"{name}:{at[x][0]}:{at[y][1]}" for name, _, x, y in matched)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(names), pa.array(spans), pa.array(cover)],
                ["id", "n_matches", "licenses", "spans", "coverage"])

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return read.mapInArrow(scan, f"id {kind}, n_matches bigint, licenses string, spans string, coverage double"
                           ).withColumnRenamed("id", id_col)
