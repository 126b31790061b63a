"""Token alignment against the libraries on whole texts and a set of end offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF0001
from sparkops.llm.queries import QUERIES
from sparkops.llm.token_alignment import alignments, lockstep, token_alignment
from support import docs_of  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}

    def groups(text):
        """[(A ids, B ids)] of a text; none if it has no tokens."""
        if not text:
            return []
        a = [(i, bytes(byte[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
             for i in sp.encode(text)]
        if {b"".join(x for _, x in a), b"".join(x for _, x in b)} != {(" " + text).encode()}:
            return []
        ends = [np.cumsum([len(x) for _, x in t]).tolist() for t in (a, b)]
        out, ka, kb = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            na, nb = ends[0].index(end) + 1, ends[1].index(end) + 1
            out.append(([i for i, _ in a[ka:na]], [i for i, _ in b[kb:nb]]))
            ka, kb = na, nb
        return out

    def result(rows):
        made = [(i, groups(t)) for i, t in rows]
        links = Counter((a[-1], b[-1]) for _, g in made for a, b in g)
        top = {}
        for (_, b), n in links.items():
            top[b] = max(n, top.get(b, 0))
        text = lambda g: ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        return sorted([(i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g),
                        sum(links[a[-1], b[-1]] == top[b[-1]] for a, b in g), sum(links[a[-1], b[-1]] for a, b in g),
                        hashlib.sha256(text(g).encode()).hexdigest() if g else "") for i, g in made], key=repr)
    return result


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


ODD = [None, "", " ", "  two  blanks ", "Plain words here", "\t tab\n\nlines \r\n end", "a▁b literal", "naïve café 日本語 \U0001f600\U0001f468‍\U0001f469",
       "<s> </s> <unk> <0x41> <|endoftext|> it's we'll", "x" * 5000, "é  nbsp  em ​", "1234567890 12,345.67", "\x00\x01nul",
       "İstanbul ſ ﬁ ½ ①", "word " * 900 + "end", "a b c d e f g h", "…“quoted” — dash", "﻿bom", "\u0085 sep"]


def test_odd_texts(spark, docs_of, plain):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice(["the ", "cat", " a", "\n", "  ", "1", "é", ",", "'s", "日", "▁x", " The", "ing ", "\t"])
                           for _ in range(rng.randrange(400))) for _ in range(40)] + ["Plain words here"] * 3
    rows = [(None if k % 11 == 5 else k // 2, t) for k, t in enumerate(texts)]
    docs = docs_of(rows)
    for clash in ("id", "row", "a", "b", "codes", "times", "count", "n_a"):
        docs = docs.withColumn(clash, F.lit("x"))
    want = plain(rows)
    assert rows_of(token_alignment(docs, A, B, slice_bytes=3000, lane_units=3)) == want
    assert rows_of(token_alignment(docs, A, B, most_pairs=1)) == want  # counts joined by a shuffle
    assert token_alignment(docs.where("false"), A, B).collect() == []


def test_query_equals_plain_version(spark, plain):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op13_token_alignment"](spark, SF0001)) == plain([tuple(r) for r in docs])


def test_links_of_texts(docs_of):
    row = alignments(docs_of(["Unbelievable alignments, 日本"]), A, B).first()
    sp, tok = sentencepiece.SentencePieceProcessor(model_file=B), Tokenizer.from_file(A)
    assert row.b == sp.encode("Unbelievable alignments, 日本") and row.a == tok.encode(" Unbelievable alignments, 日本").ids
    assert len(row.link_a) == len(row.link_b) and (row.link_a[-1], row.link_b[-1]) == (len(row.a) - 1, len(row.b) - 1)
    assert row.link_a == sorted(row.link_a) and row.link_b == sorted(row.link_b)


@pytest.mark.parametrize("seed", range(5))
def test_lockstep(seed):
    rng = np.random.default_rng(seed)
    a, b = [], []
    for n in rng.integers(1, 60, 30):
        for side in (a, b):
            side.append(np.unique(np.append(rng.integers(1, n + 1, rng.integers(n)), n)))
    cut_a, cut_b = lockstep(np.concatenate(a), np.array([len(x) for x in a]), np.concatenate(b), np.array([len(x) for x in b]))
    assert cut_a.tolist() == np.concatenate([np.isin(x, y) for x, y in zip(a, b)]).tolist()
    assert cut_b.tolist() == np.concatenate([np.isin(y, x) for x, y in zip(a, b)]).tolist()
