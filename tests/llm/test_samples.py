"""Bounded samples of very many rows: never empty, and from all over the texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldpan.llm import language
from goldpan.llm.common import hash_share
from tests.llm.helpers import frame


def test_a_large_language_keeps_a_dictionary(spark):
    large = spark.range(1_500_000).select(
        F.col("id").alias("doc_id"), F.lit("the quick brown fox").alias("text"), F.lit("en").alias("lang")
    )
    small = large.limit(3).withColumn("text", F.lit("der schnelle Fuchs")).withColumn("lang", F.lit("de"))
    found = language.fit(large.unionByName(small), rows=1)
    assert list(found) == ["en", "de"]


def test_rows_without_ids_are_learned_from(spark):
    rows = frame(spark, [(None, "and more " + bin(i)[2:].translate({48: "a", 49: "b"})) for i in range(3000)])
    assert language.fit(rows, rows=400)["en"].count(b"and more") > 100


def test_dictionaries_come_from_all_over_the_texts(spark):
    licence = "permission is hereby granted " * 80
    rows = [(i, licence + f"body{chr(97 + i)} " * 2000) for i in range(20)]
    found = language.fit(frame(spark, rows))["en"]
    assert all(f"body{chr(97 + i)}".encode() in found for i in range(20))


def test_a_share_of_the_hash_range_does_not_round_to_none(spark):
    n = spark.range(1 << 22)
    place = F.xxhash64("id")
    for share, low, high in ((1.0, 1 << 22, 1 << 22), (0.5, 2_090_000, 2_104_000), (4e-6, 5, 35)):
        assert low <= n.filter(hash_share(place, share)).count() <= high
    last = spark.range(1).select(hash_share(F.lit(-(1 << 63)).cast("long") + 10**8, 1e-11)).first()[0]
    assert last
