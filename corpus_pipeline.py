"""A training corpus from raw documents, in five stages.

Language ID (documents it rejects go), line dedup, SimHash near-dedup (one
document of each group stays), mixing of the sources to target weights, and
byte-level BPE.  Each stage takes what the one before kept, written as Parquet;
all but the last return the columns of ``documents``.

Defined results: a document rejected by language ID, one with no letters
included, is gone; a document whose every line goes stays with an empty text,
and all such documents are one near-dup group; mixing repeats and leaves out
documents by their Poisson counts, so the last stage has a row per copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket.llm import bpe, language_id, line_dedup, mixing, simhash
from pricebasket.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs, language_id.train(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(docs)
    return left.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_dups(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, mixing.WEIGHTS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: Fingerprints, character models and merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
