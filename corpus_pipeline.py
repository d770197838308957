"""The corpus pipeline: documents in, token ids of the clean ones out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm import bpe, decontaminate, minhash, pii, toxicity
from goldpan.llm.common import documents, saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that score 0.5 or more go.

    The model learns from the labelled documents of the stage's input that are not held out.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.filter(~toxicity.held_out(F.col("doc_id")))
    return toxicity.keep_clean(spark, docs, toxicity.fit(spark, docs, labels))


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the document with the least id of each near-duplicate class stays."""
    return minhash.keep_one(spark, docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark passage go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_leaks(spark, docs, benchmark)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: personal data and terms that disclose it give way to their kind's name."""
    return pii.redact(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token ids of each text and the text they decode to, as digests."""
    return bpe.encode_texts(spark, docs, digest=True)


STAGES = [
    ("drop_toxic", drop_toxic),
    ("drop_duplicates", drop_duplicates),
    ("drop_leaked", drop_leaked),
    ("redact", redact),
    ("encode", encode),
]

# Learned scores, sketches and merges have no SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
