"""Trained variant of the review label (J2b, D): hashed words and logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.functions.text import words
from goldpan.session import scratch_dir


def fit_classifier(
    reviews: DataFrame,
    labels: DataFrame,
    features: int = 1 << 12,
    regularisation: float = 0.1,
    iterations: int = 50,
) -> PipelineModel:
    """Fit on the labelled reviews. Each pass is a distributed sum over sparse
    vectors; only the coefficients, ``features`` of them, reach the driver.

    Repeated labels of a review are counted into a weight before the join, which
    gives the same fit as joining every copy. Only reviews with a label are
    split into words.

    The model comes back from the shared folder, without the summary of its training: that
    holds the session, which cannot be sent to tasks once something was observed in it.
    """
    weighted = labels.groupBy("id_review", F.col("label").cast("double").alias("label")).agg(
        F.count("*").cast("double").alias("weight")
    )
    stages = [
        HashingTF(inputCol="words", outputCol="features", numFeatures=features),
        LogisticRegression(
            regParam=regularisation,
            maxIter=iterations,
            weightCol="weight",
            # scaling by deviation would treat a weight and as many copies differently
            standardization=False,
        ),
    ]
    labelled = reviews.join(weighted, "id_review")
    fitted = Pipeline(stages=stages).fit(_with_words(labelled, "label", "weight"))
    path = scratch_dir(reviews.sparkSession, "classifier")
    fitted.save(path)
    return PipelineModel.load(path)


def classify(model: PipelineModel, reviews: DataFrame) -> DataFrame:
    """``id_review`` and the predicted 0/1 ``positive_review`` of each review."""
    scored = model.transform(_with_words(reviews, "id_review"))
    return scored.select("id_review", F.col("prediction").cast("int").alias("positive_review"))


def _with_words(reviews: DataFrame, *kept: str) -> DataFrame:
    text = F.coalesce("review_str", F.lit(""))
    return reviews.select(*kept, words(text).alias("words"))
