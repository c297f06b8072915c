"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. language_id      drops documents whose text is in none of the learned languages (or has no letter);
2. line_dedup       takes later copies of repeated line runs out of the texts; documents of which nothing is left go;
3. jaccard_join     keeps one document (the smallest id) of each group of near-duplicates; blank documents stay;
4. decontamination  drops documents that hold passages of ``benchmark``;
5. byte_bpe         encodes every kept text and checks that the ids decode to it.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and survives lost executors: between stages
there are only written tables.  All but the last return the columns of ``docs`` as they came, with null ids and texts handled
as the operators state.  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskhouse.llm import bpe, decontaminate, jaccard, langid, lines
from riskhouse.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.keep_deduplicated(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokenized(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language scores, byte merges and exact similarity joins have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None
