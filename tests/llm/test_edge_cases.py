"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkops.llm import (decontaminate, language_id, license_scan, mixing, ngram_join, secret_scan, substring_dedup,
                          token_binary, token_counts, vp_tree)
from support import docs_of  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
CLASH = ["id", "row", "token", "n", "key", "tid", "pos", "rep", "root", "a", "b", "part", "block", "sum", "h", "r", "whole"]


def bench(spark, rows=((1, "alpha beta gamma delta epsilon"), (2, None), (None, "one two"), (4, " .. "))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "secret": lambda s, d: secret_scan.secret_scan(d),
    "mix": lambda s, d: mixing.mix(d),
    "join": lambda s, d: ngram_join.ngram_jaccard_join(d),
    "binary": lambda s, d: token_binary.token_binary(d, PATH),
    "license": lambda s, d: license_scan.license_scan(d),
    "decontaminate": lambda s, d: decontaminate.decontaminate(d, bench(s)),
    "counts": lambda s, d: token_counts.token_counts(d, PATH),
    "substring": lambda s, d: substring_dedup.substring_dedup(d),
    "language": lambda s, d: language_id.language_id(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, docs_of, name):
    assert OPERATORS[name](spark, docs_of(["x"]).where("false")).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(spark, docs_of, name):
    long = "lorem ipsum " * 30_000
    texts = [(1, None), (2, ""), (3, " \t\n"), (None, "a null id"), (5, "twice"), (5, "twice"), (6, long),
             (7, "\U0001f600 été \x00 café"), (8, None), (None, None)]
    docs = docs_of(texts, lang=["en", None, "en", "en", "de", "de", None, "fr", None, "en"])
    docs = docs.withColumn("source", F.when(F.col("doc_id") != 7, F.col("source")))
    for c in CLASH:
        docs = docs.withColumn(c, F.lit("x"))
    got = OPERATORS[name](spark, docs).collect()
    if name != "mix":
        assert sorted((r.doc_id is None, r.doc_id) for r in got if r.doc_id) == [
            (False, i) for i in (1, 2, 3, 5, 5, 6, 7, 8)]
        assert len(got) == 10


def test_stages_keep_columns_and_odd_rows(spark, docs_of, tmp_path):
    bench(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [(1, None), (2, ""), (None, "the words of a null id"), (5, "said twice here"), (5, "said twice here"),
             (6, "alpha beta gamma delta epsilon"), (7, "not one of those words at all")]
    docs = docs_of(texts)
    for c in CLASH:
        docs = docs.withColumn(c, F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.schema.names == docs.schema.names
            out.write.parquet(str(tmp_path / f"out{k}"))
            docs = spark.read.parquet(str(tmp_path / f"out{k}"))
            kept[name] = sorted((r.doc_id is None, r.doc_id) for r in docs.collect())
        else:
            assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == len(kept["source_mixing"])
    assert kept["language_id"] == [(False, 5), (False, 5), (False, 6), (False, 7), (True, None)]
    assert kept["ngram_jaccard_join"] == [(False, 5), (False, 6), (False, 7), (True, None)]
    assert kept["benchmark_decontamination"] == [(False, 5), (False, 7), (True, None)]
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_near_copies_of_the_stage(spark, docs_of, tmp_path):
    one = [f"w{i}" for i in range(50)]
    other = [*one[:25], "changed", *one[26:]]  # 41 of 51 shingles of 5 words; of 4 words 43 of 51
    more = [f"v{i}" for i in range(54)]
    docs = docs_of([" ".join(x) for x in (one, other, more[:44], more)])  # 40 of 50
    assert sorted(r.doc_id for r in corpus_pipeline.deduplicated(spark, docs, str(tmp_path)).collect()) == [0, 2]


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (50, [1.0, 1.0]), (50, [2.0, 2.0]), (100, [1.0, 2.0, 3.0]),
            (150, [1e-200, 1e-200])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit(1))
    got = vp_tree.nearest(t, F.col("id") % 50 == 0)
    by = {}
    for r in got.collect():
        by.setdefault((r.query_id, r["rank"]), set()).add(r.vec_id)
    # Both rows 50 find one another; 100 has no other vector of its length.
    assert by[50, 1] == {50} and 100 not in {q for q, _ in by} and max(k for _, k in by) == 3
    assert vp_tree.nearest(t.where("false"), F.col("id") % 50 == 0).collect() == []


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    from sparkops.llm._common import SHUFFLE_CLEANUP, write_table

    def held():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    had, rows = spark.conf.get(SHUFFLE_CLEANUP, None), spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    for n in range(2):  # the same rows may be written again
        before = held()
        write_table(rows, str(tmp_path / f"out{n}"))
        assert held() <= before
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / f"out{n}")).collect())) == [(k, 143 - (k == 6)) for k in range(7)]
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == had
    with pytest.raises(Exception, match="already exists"):
        write_table(rows, str(tmp_path / "out0"))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == had


def test_pipeline_sends_small_batches(spark, docs_of):
    from sparkops.llm._common import BATCH_BYTES, BATCH_ROWS, small_batches

    def largest():
        def sizes(batches):
            import pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

        return spark.range(6000).coalesce(1).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    had = {k: spark.conf.get(k, None) for k in (BATCH_ROWS, BATCH_BYTES)}
    try:
        for _, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[1], corpus_pipeline.STAGES[4]):
            spark.conf.unset(BATCH_ROWS)
            stage(spark, docs_of(["one two three four five"] * 4), "")
            assert largest() <= 1000
        spark.conf.set(BATCH_ROWS, "300")
        small_batches(spark)
        assert spark.conf.get(BATCH_ROWS) == "300"
    finally:
        for key, value in had.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
