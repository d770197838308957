"""Silver transforms.

Inputs, outputs and the format argument are E; the transform bodies are not
published, so column rules here are D and come in as arguments where they can.
All are narrow: one pass over the input and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.functions.stopwords import ENGLISH_STOP_WORDS
from goldpan.functions.text import any_word_in, words
from goldpan.functions.xml import infer_xml_schema, parse_xml
from goldpan.schemas import LOG_PAYLOAD, LOG_ROW_TAG, USER_PURCHASE

DEFAULT_LEXICON = ("good",)


def review_logs(
    logs: DataFrame,
    payload: T.StructType | None = LOG_PAYLOAD,
    row_tag: str = LOG_ROW_TAG,
    rename: dict[str, str] | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """XML payload of each log line as columns beside its ``id_review``.

    Without a ``payload`` its schema is that of all log lines together, found first.
    """
    if payload is None:
        payload = infer_xml_schema(logs, "log", row_tag)
    if not payload.fields:
        return logs.select("id_review")
    rename = {"userId": "user_id"} if rename is None else rename
    fields = parse_xml(F.col("log"), payload, row_tag, mode)
    # a generator, so that a filter on a field does not parse the payload a second time
    return logs.select("id_review", F.inline(F.array(fields))).withColumnsRenamed(rename)


def classified_reviews(
    reviews: DataFrame,
    lexicon: Iterable[str] = DEFAULT_LEXICON,
    stop_words: Iterable[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Word count and 0/1 label of each review's whole text."""
    split = reviews.select("id_review", words(F.col("review_str"), stop_words).alias("words"))
    return split.select(
        "id_review",
        F.coalesce(F.size("words").cast("bigint"), F.lit(0).cast("bigint")).alias("n_words"),
        any_word_in(F.col("words"), lexicon).alias("positive_review"),
    )


def user_purchase(purchases: DataFrame) -> DataFrame:
    """The purchase columns, unchanged (J3); no cleaning rule is known, so none is applied."""
    return purchases.select(*USER_PURCHASE.names)
