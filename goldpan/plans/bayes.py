"""Trained review label by multinomial naive Bayes, as grouped counts and joins (J2b, D).

The model is a table of word weights. It is never collected, whatever the vocabulary, and
SQL says the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.functions.text import words

# scores are compared after rounding, so that the order of a sum decides nothing
_DIGITS = 9


def _each_word(reviews: DataFrame, *kept: str) -> DataFrame:
    split = words(F.coalesce("review_str", F.lit("")))
    return reviews.select(*kept, F.explode(split).alias("word"))


def _counted_words(reviews: DataFrame, *kept: str) -> DataFrame:
    """``kept, word, n``: each row's distinct words with how often they occur in it.

    Equal words lie together in sorted order: where a run begins, and where the next one
    does, gives its length.
    """
    split = F.array_sort(words(F.coalesce("review_str", F.lit(""))))
    ordered = reviews.select(*kept, split.alias("words")).filter(F.size("words") > 0)
    begins = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: (i == 0) | (F.get("words", i) != F.get("words", i - 1)),
    )
    ordered = ordered.select(*kept, "words", begins.alias("begins"))
    runs = F.transform(
        "begins",
        lambda begin, run: F.struct(
            F.get("words", begin).alias("word"),
            (F.coalesce(F.get("begins", run + 1), F.size("words")) - begin).alias("n"),
        ),
    )
    return ordered.select(*kept, F.inline(runs))


def fit(reviews: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The weights ``word, weight`` and the one-row table ``prior``.

    ``weight`` is the logarithm of how much likelier the word is in a review with label 1,
    one occurrence of every known word added to each label; ``prior`` that of the labels
    themselves, one review added to each. A review counts once for every label it has.
    """
    known = labels.groupBy("id_review", F.col("label").cast("int").alias("label"))
    known = known.agg(F.count("*").alias("times")).filter("label in (0, 1)")
    labelled = reviews.join(known, "id_review")
    ones, zeros = (F.when(F.col("label") == label, F.col("times")).otherwise(0) for label in (1, 0))
    prior = labelled.agg(
        (
            F.log(F.coalesce(F.sum(ones), F.lit(0)) + 1.0)
            - F.log(F.coalesce(F.sum(zeros), F.lit(0)) + 1.0)
        ).alias("prior")
    )
    by_word = _each_word(labelled, "label", "times").groupBy("word")
    by_word = by_word.agg(F.sum(ones).alias("in1"), F.sum(zeros).alias("in0"))
    totals = by_word.agg(
        F.sum("in1").alias("all1"), F.sum("in0").alias("all0"), F.count("*").alias("vocabulary")
    )

    def share(label: int):
        return (F.col(f"in{label}") + 1.0) / (F.col(f"all{label}") + F.col("vocabulary"))

    # the totals are one row
    weighed = by_word.join(F.broadcast(totals))
    return weighed.select("word", (F.log(share(1)) - F.log(share(0))).alias("weight")), prior


def classify(weights: DataFrame, prior: DataFrame, reviews: DataFrame) -> DataFrame:
    """``id_review, score, positive_review`` of every review; unknown words weigh nothing.

    A review's words are counted inside its row before they are moved to the weights, so a
    frequent word comes once for each review and no task keeps the counts of many reviews,
    and AQE splits a word that most reviews have. Reviews that repeat both id and text are
    scored once and all returned; ids may repeat with other texts.
    """
    keyed = reviews.select("id_review", "review_str", F.md5("review_str").alias("text_key"))
    once = keyed.dropDuplicates(["id_review", "text_key"])
    counted = _counted_words(once, "id_review", "text_key")
    scored = counted.join(weights, "word").groupBy("id_review", "text_key")
    scored = scored.agg(F.sum(F.col("n") * F.col("weight")).alias("sum"))
    scored = scored.toDF("scored_id", "scored_key", "sum")
    same = F.col("id_review").eqNullSafe(F.col("scored_id")) & (F.col("text_key") == F.col("scored_key"))
    found = keyed.join(scored, same, "left").join(F.broadcast(prior))
    score = F.round(F.col("prior") + F.coalesce("sum", F.lit(0.0)), _DIGITS)
    return found.select(
        "id_review", score.alias("score"), (score >= 0).cast("int").alias("positive_review")
    )
