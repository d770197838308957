"""Rows that every operator must take: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "That  it"),
    (5, "that it."),
    (5, "that it."),
    (None, "a null id with a text of seven words"),
    (6, "word " * 5000),
    (7, "x" * 20000),
    (8, "Ünïcode 漢字 🙂 ½ İ ΣΑΣ \x1c\x85 <|endoftext|> it's 12.5"),
    (9, "one two three four five six seven eight nine ten eleven\n" * 3),
]


def frame(spark: SparkSession, rows) -> DataFrame:
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd(spark: SparkSession) -> DataFrame:
    return frame(spark, ODD_TEXTS)


def clashing(df: DataFrame) -> DataFrame:
    """Extra columns whose names the operators use themselves."""
    for name in ("key", "label", "band", "spans", "base", "score", "host", "id", "node", "words"):
        df = df.selectExpr("*", f"cast(null as string) as {name}")
    return df
