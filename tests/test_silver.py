from __future__ import annotations

import re

import pytest
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.functions.stopwords import ENGLISH_STOP_WORDS
from goldpan.functions.text import words
from goldpan.plans import silver
from goldpan.plans import star_inputs as star
from goldpan.schemas import CLASSIFIED_REVIEW, LOG_REVIEWS, MOVIE_REVIEW, REVIEW_LOGS
from tests.conftest import JOB_ERRORS, shape, values

SMALL = "/root/testdata/sf0.001"
LOG = "<log><userId>7</userId><device>phone</device><score>0.5</score></log>"


def test_log_payload_becomes_columns(spark):
    logs = spark.createDataFrame(
        [
            (1, LOG),
            (2, "<log>\n  <score>2</score>\n  <userId>8</userId>\n</log>"),
            (3, "<log><userId>"),
            (4, None),
            (5, "<log><userId>9</userId><device>a &amp; b</device></log>"),
        ],
        LOG_REVIEWS,
    )
    result = silver.review_logs(logs)
    assert shape(result.schema) == shape(REVIEW_LOGS)
    assert values(result) == sorted(
        [
            (1, 7, "phone", 0.5),
            (2, 8, None, 2.0),
            (3, None, None, None),
            (4, None, None, None),
            (5, 9, "a & b", None),
        ],
        key=repr,
    )


def test_malformed_logs_can_fail_the_job(spark):
    logs = spark.createDataFrame([(1, LOG), (2, "<log><userId>")], LOG_REVIEWS)
    with pytest.raises(JOB_ERRORS):
        silver.review_logs(logs, mode="FAILFAST").collect()


def test_payload_schema_and_tag_are_arguments(spark):
    logs = spark.createDataFrame([(1, "<entry><ip>10.0.0.1</ip></entry>")], LOG_REVIEWS)
    payload = T.StructType([T.StructField("ip", T.StringType())])
    result = silver.review_logs(logs, payload, "entry", rename={"ip": "address"})
    assert result.columns == ["id_review", "address"]
    assert values(result) == [(1, "10.0.0.1")]


def test_log_transform_parses_once_and_never_shuffles(spark):
    plan = _plan(silver.review_logs(star.log_reviews(spark, SMALL)))
    assert plan.count("from_xml(") == 1
    assert "Exchange" not in plan


def test_reviews_are_labelled(spark):
    reviews = spark.createDataFrame(
        [
            (1, "A GOOD film, really good!"),
            (2, "Goodness, what a bore"),
            (3, "the of and"),
            (4, ""),
            (5, None),
            (6, "so-so... 2good4u"),
        ],
        MOVIE_REVIEW,
    )
    result = silver.classified_reviews(reviews, lexicon=["Good"])
    assert shape(result.schema) == shape(CLASSIFIED_REVIEW)
    assert values(result) == [
        (1, 4, 1),
        (2, 2, 0),
        (3, 0, 0),
        (4, 0, 0),
        (5, 0, 0),
        (6, 2, 1),
    ]


def test_stop_words_in_the_lexicon_never_match(spark):
    reviews = spark.createDataFrame([(1, "the film")], MOVIE_REVIEW)
    assert silver.classified_reviews(reviews, ["the"]).first().positive_review == 0
    assert silver.classified_reviews(reviews, ["the"], stop_words=[]).first().positive_review == 1


def test_empty_lexicon_matches_nothing(spark):
    reviews = spark.createDataFrame([(1, "a film")], MOVIE_REVIEW)
    assert silver.classified_reviews(reviews, []).first().positive_review == 0


def test_stop_words_are_the_published_list(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_words_equal_tokenizer_and_stop_word_filter(spark):
    reviews = star.movie_reviews(spark, SMALL)
    tokens = RegexTokenizer(inputCol="review_str", outputCol="t", pattern="[^a-z]+")
    remover = StopWordsRemover(
        inputCol="t", outputCol="expected", stopWords=list(ENGLISH_STOP_WORDS)
    )
    both = remover.transform(tokens.transform(reviews)).withColumn(
        "actual", words(F.col("review_str"))
    )
    assert both.filter("actual != expected").count() == 0


def test_labels_equal_plain_python(spark):
    reviews = star.movie_reviews(spark, SMALL)
    lexicon = {"worthless", "ble"}
    expected = []
    for row in reviews.collect():
        kept = [
            word
            for word in re.split("[^a-z]+", row.review_str.lower())
            if word and word not in ENGLISH_STOP_WORDS
        ]
        expected.append((row.id_review, len(kept), int(bool(lexicon & set(kept)))))
    assert values(silver.classified_reviews(reviews, lexicon)) == sorted(expected, key=repr)


def test_review_transform_never_shuffles_and_reads_two_columns(spark):
    plan = _plan(silver.classified_reviews(star.movie_reviews(spark, SMALL)))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
