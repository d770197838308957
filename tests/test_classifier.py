from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from pyspark.ml.feature import HashingTF
from pyspark.sql import Observation
from pyspark.sql import functions as F

from goldpan.functions.text import words
from goldpan.plans import bayes, classifier
from goldpan.schemas import MOVIE_REVIEW
from tests.conftest import values

REVIEWS = [
    (1, "good film"),
    (2, "good good plot"),
    (3, "bad film"),
    (4, "bad bad plot"),
    (5, "good"),
    (6, None),
    (7, "bad"),
]
LABELS = [(1, 1), (2, 1), (3, 0), (4, 0), (1, 1)]


def test_fit_is_the_minimum_of_the_weighted_loss(spark):
    reviews = spark.createDataFrame(REVIEWS, MOVIE_REVIEW)
    labels = spark.createDataFrame(LABELS, "id_review bigint, label int")
    model = classifier.fit_classifier(
        reviews, labels, features=16, regularisation=0.1, iterations=200
    )
    fitted = model.stages[-1]
    labelled = reviews.join(labels, "id_review").select(
        "label", words(F.col("review_str")).alias("words")
    )
    rows = HashingTF(inputCol="words", outputCol="f", numFeatures=16).transform(labelled).collect()
    x = np.array([row.f.toArray() for row in rows])
    y = np.array([row.label for row in rows])
    error = 1 / (1 + np.exp(-(x @ fitted.coefficients.toArray() + fitted.intercept))) - y
    gradient = x.T @ error / len(y) + 0.1 * fitted.coefficients.toArray()
    assert abs(error.mean()) < 1e-5
    assert np.abs(gradient).max() < 1e-5
    assert len(rows) == len(LABELS)


def test_reviews_are_classified_whole(spark):
    reviews = spark.createDataFrame(REVIEWS, MOVIE_REVIEW)
    labels = spark.createDataFrame(LABELS, "id_review bigint, label int")
    model = classifier.fit_classifier(reviews, labels)
    labelled = dict(values(classifier.classify(model, reviews)))
    assert set(labelled) == {row[0] for row in REVIEWS}
    assert labelled[5] == 1 and labelled[7] == 0
    assert set(labelled.values()) == {0, 1}


def test_reviews_are_classified_in_a_session_that_has_observed_rows(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get == {"rows": 3}
    reviews = spark.createDataFrame(REVIEWS, MOVIE_REVIEW)
    labels = spark.createDataFrame(LABELS, "id_review bigint, label int")
    model = classifier.fit_classifier(reviews, labels)
    assert len(values(classifier.classify(model, reviews))) == len(REVIEWS)
    assert not model.stages[-1].hasSummary


def test_naive_bayes_equals_a_plain_count(spark):
    rng = random.Random(7)
    vocabulary = ["fine", "dull", "plot", "actor", "scene", "the"]
    rows = [(i % 40, " ".join(rng.choices(vocabulary, k=rng.randint(0, 6)))) for i in range(45)]
    rows += [(90, None), (91, ""), (None, "fine plot"), (92, "unknown words"), (93, "dull"), (93, "dull")]
    marks = [(rng.randint(0, 50), rng.randint(0, 1)) for _ in range(60)] + [(1, None), (None, 1)]
    reviews = spark.createDataFrame(rows, "id_review long, review_str string")
    labels = spark.createDataFrame(marks, "id_review long, label int")
    pairs = [
        ((t or "").split(), m) for i, t in rows for j, m in marks if i is not None and i == j and m is not None
    ]
    counts = {m: Counter(w for ws, n in pairs if n == m for w in ws if w != "the") for m in (0, 1)}
    known = set(counts[0]) | set(counts[1])

    def weight(word):
        share = [(counts[m][word] + 1) / (sum(counts[m].values()) + len(known)) for m in (0, 1)]
        return math.log(share[1]) - math.log(share[0])

    prior = [math.log(sum(m == label for _, m in pairs) + 1) for label in (0, 1)]
    expected = [
        (i, round(prior[1] - prior[0] + sum(weight(w) for w in (t or "").split() if w in known), 7))
        for i, t in rows
    ]
    found = bayes.classify(*bayes.fit(reviews, labels), reviews).collect()
    assert sorted(((r.id_review, round(r.score, 7)) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(r.positive_review == (r.score >= 0) for r in found)
    nothing = bayes.fit(reviews.limit(0), labels)
    assert {r.positive_review for r in bayes.classify(*nothing, reviews).collect()} == {1}


def test_naive_bayes_counts_words_inside_their_rows(spark):
    rows = [(1, "fine plot, fine end"), (2, "the"), (3, None), (4, "Plot")]
    reviews = spark.createDataFrame(rows, MOVIE_REVIEW)
    counted = bayes._counted_words(reviews, "id_review")
    expected = [(1, "end", 1), (1, "fine", 2), (1, "plot", 1), (4, "plot", 1)]
    assert values(counted) == sorted(expected, key=repr)
    weights = spark.createDataFrame([("fine", 1.0), ("plot", -3.0)], "word string, weight double")
    prior = spark.createDataFrame([(0.5,)], "prior double")
    found = bayes.classify(weights, prior, reviews)
    assert values(found) == [(1, -0.5, 0), (2, 0.5, 1), (3, 0.5, 1), (4, -2.5, 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("Aggregate [")[1].split("]")[0] for line in plan.splitlines() if "Aggregate [" in line]
    assert keys and not any("word#" in key for key in keys)
