"""A training corpus from raw documents: five stages, each written and read again.

    from corpus_pipeline import run
    corpus = run(spark, "/data/sf0.1")

Each stage is (name, function of (spark, docs, sf_dir)). All but the last return the columns of
documents, extra ones included; the last adds how many words of each document the mix takes. Every
stage takes an empty table and gives one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from tallyhouse.llm.shared import checkpoint_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit; labels of `sf_dir` train the model.

    Every row is judged by its own text, so null and repeated doc_ids change nothing. Null and empty
    texts stay, and so do all rows if there are no labels of both kinds."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts exactly one row: one with the largest doc_id, a missing id being the smallest.

    Null and empty texts are equal. Rows that repeat a doc_id are told apart by their texts."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates exactly one row: the one with the smallest doc_id, a missing id being the
    greatest.

    Texts without words are like no other; of rows with the same doc_id and text one stays."""
    return near_dedup.keep_one(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark of `sf_dir`.

    Every row is judged by its own text, so null and repeated doc_ids change nothing. Null and empty
    texts stay, and so do all rows if the benchmark is empty."""
    return decontamination.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words the mix takes.

    These columns replace any of the same names. A null source is a source; nothing is taken of null
    and empty texts. Rows that repeat a doc_id have shares of their own."""
    return mixing.with_shares(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaked),
    ("mixing", mix_sources),
]

#: SQL can express neither the ordinal regression nor the signatures; tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each written as Parquet below the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4()}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
