"""From raw documents to token digests: five stages, each written as Parquet and read back by the next.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of documents; the last returns the tokens' digests. Rows that a stage
rejects are gone for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import byte_bpe, decontam, langid, line_dedup, simhash
from quarry.llm.tables import table
from quarry.operators.state import shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without letters, or with most letters in no learned language, go."""
    return langid.stage(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that a later document holds and at least three share."""
    return line_dedup.stage(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash.stage(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontam.stage(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of the documents that are left."""
    return byte_bpe.stage(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("simhash", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

#: XXH64 fingerprints, Viterbi labels and byte-pair merges have no SQL; tests hold each stage, and the whole run, against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's table goes when the next one's is written; the last stays, as the result reads it."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    written: list[str] = []
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            written.append(f"{folder}/{k}-{name}")
            docs.write.parquet(written[-1])
            docs = spark.read.parquet(written[-1])
            for old in written[:-1]:
                path(old).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(old), True)
    return docs
