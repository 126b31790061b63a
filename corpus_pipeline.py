"""From raw documents to token files: five stages, each of one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the
columns they got. Null and empty texts have no letter, so the first stage
rejects them; extra columns pass through, whatever their names. Rows that
repeat an id or a whole row are rows of their own to every stage; the second
keeps one of each group of copies. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkops.llm import decontaminate, language_id, mixing, ngram_join, token_binary
from sparkops.llm._common import small_batches, stored, table, workers_import
from sparkops.llm.queries import tokenizer_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in none of the languages that their labels teach."""
    workers_import(spark)
    small_batches(spark)
    model = language_id.train(docs.where(~language_id.held_out()), key=F.col("doc_id"))
    return language_id.accepted(docs, model)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep, of documents linked by four fifths of their 5-word shingles, the one of the smallest id."""
    workers_import(spark)
    small_batches(spark)
    return ngram_join.one_of_each(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a benchmark's windows cover one word in twenty."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents by the sources' weights; a small source's may come twice."""
    return mixing.mix(docs, key=F.col("doc_id")).select(*(F.col(f"`{c}`") for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what they hold of each document."""
    workers_import(spark)
    small_batches(spark)
    return token_binary.token_binary(docs, tokenizer_path())


STAGES = [("language_id", identified), ("ngram_jaccard_join", deduplicated),
          ("benchmark_decontamination", decontaminated), ("source_mixing", mixed), ("token_binary", encoded)]

# Training, hashing by key and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
