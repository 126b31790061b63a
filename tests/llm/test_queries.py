"""The registered queries on the given tables: against DuckDB where SQL can say
it, else against plain versions; and the whole pipeline on a small input."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF0001
from sparkops.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from sparkops.plans.compare import duckdb_conn
from support import docs_of  # noqa: F401


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF0001)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF0001)
    assert sorted(got.columns) == sorted(want.columns)
    tidy = lambda row: tuple(round(x, 9) if isinstance(x, float) else x for x in row)
    assert sorted(map(tidy, got.select(*want.columns).collect())) == sorted(map(tidy, want.fetchall()))


def test_every_operator_has_a_query():
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES}) == list(range(1, 14))


def test_held_out_languages(spark, con):
    lang = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op10_language_id"](spark, SF0001).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95


def test_token_files_of_the_table(spark, con):
    tok, start = Tokenizer.from_file(tokenizer_path()), 0
    got = {r.doc_id: r for r in QUERIES["op4_token_binary"](spark, SF0001).collect()}
    for i, text in con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens) == (start, len(ids))
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_secrets_of_the_table(spark, con):
    got = {r.doc_id: r for r in QUERIES["op1_secret_scan"](spark, SF0001).collect()}
    for i, text in con.sql("SELECT doc_id, text FROM documents").fetchall():
        hexes = [m for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
        assert got[i].n_hex == len(hexes)
        if not got[i].n_assign + got[i].n_access:
            text = ",".join(f"hex:{m.start()}:{m.end()}" for m in hexes)
            assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline(spark, tmp_path, docs_of):
    item = " ".join(f"bench{i}" for i in range(30))
    base = [" ".join(f"word{chr(97 + k)}{chr(97 + i % 26)}" for i in range(j, j + 40)) for k, j in enumerate(range(24))]
    texts = base + [base[0], base[1].upper(), base[2] + " more", item, base[3] + " " + item, "жщъы фяюэ " * 40, None, "12 !"]
    docs = docs_of(texts, lang=[None if t and t.startswith("ж") else "en" for t in texts])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    # Rejected: no words of the language; then copies and near copies; then the two with the item.
    kept = [i for i in range(24)]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    assert {r.doc_id for r in got} <= set(kept) and len({r.doc_id for r in got}) >= 16
    start = 0
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        ids = [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
