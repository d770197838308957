"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm import (
    bpe,
    conversations,
    decontaminate,
    hosts,
    infill,
    language,
    minhash,
    overlap,
    pages,
    pii,
    quality,
    token_files,
    toxicity,
)
from goldpan.llm.common import documents


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    classes = minhash.near_duplicates(spark, documents(spark, folder))
    return classes.select("doc_id", "class_id")


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every text, with terms that disclose it."""
    return pii.span_digests(spark, documents(spark, folder))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document, with its place there."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.find_leaks(spark, documents(spark, folder), benchmark)


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text."""
    return language.predict(spark, documents(spark, folder))


def op5_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """The rule, the posterior and the verdict for the url of every page."""
    urls = spark.read.parquet(f"{folder}/pages.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = hosts.judge_urls(urls, labels)
    return judged.withColumns({name: F.round(name, 6) for name in ("rate", "bound")})


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text by the transducer lexicon, and the text they decode to."""
    return bpe.encode_texts(spark, documents(spark, folder), digest=True)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every text and the verdict of the learned decision list."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality.judge(spark, documents(spark, folder), labels)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity score of every text."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.predict(spark, documents(spark, folder), labels)


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, written to token files and read back."""
    return token_files.token_digests(spark, documents(spark, folder))


def op10_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page, without its site's templates."""
    return pages.extract_text(spark, spark.read.parquet(f"{folder}/pages.parquet"))


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and repaired form of every conversation, after damage."""
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    return conversations.repair_damaged(spark, rows)


def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    """Fill-in-the-middle form of every text, and the text restored from it."""
    return infill.digests(documents(spark, folder))


def op13_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document over links of similar sets of runs of words."""
    return overlap.join_components(spark, documents(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            op1_minhash,
            op2_pii,
            op3_decontaminate,
            op4_language,
            op5_hosts,
            op6_bpe,
            op7_quality,
            op8_toxicity,
            op9_token_files,
            op10_pages,
            op11_conversations,
            op12_infill,
            op13_overlap,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_hosts": hosts.oracle(),
        "op12_infill": infill.oracle(),
        "op13_overlap": overlap.oracle(),
    }
