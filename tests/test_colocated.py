from __future__ import annotations

import random
import re
import uuid

import pytest

from goldpan.plans import colocated, gold
from goldpan.schemas import CLASSIFIED_REVIEW, REVIEW_LOGS, USER_PURCHASE
from tests.conftest import values
from tests.test_gold import brute_force, purchase


@pytest.fixture
def written(spark, tmp_path):
    def write(classified, logs, **sizes):
        name = f"colocated_{uuid.uuid4().hex}"
        colocated.write_colocated(
            spark.createDataFrame(classified, CLASSIFIED_REVIEW),
            spark.createDataFrame(logs, REVIEW_LOGS),
            name,
            f"{tmp_path}/{name}",
            **sizes,
        )
        return name

    return write


def random_rows(seed, hot):
    draw = random.Random(seed)
    classified = [
        (draw.choice([None, *range(12)]), 3, draw.choice([0, 1])) for _ in range(40)
    ]
    ids = [None, *range(15), *[7] * hot]
    logs = [(draw.choice(ids), draw.choice([None, 1, 2, 5_000_000_000]), "d", 1.0) for _ in range(200)]
    return classified, logs


@pytest.mark.parametrize("hot", [0, 30])
def test_equals_brute_force(spark, written, hot):
    classified, logs = random_rows(hot, hot)
    purchases = [purchase(customer, 2, "1.500") for customer in (1, 2, 3, None)]
    name = written(classified, logs, buckets=8, parts=4)
    result = gold.with_reviews(
        spark.createDataFrame(purchases, USER_PURCHASE), colocated.reviews_by_customer(spark, name)
    )
    assert values(result) == brute_force(purchases, classified, logs)


def test_empty_tables(spark, written):
    assert colocated.reviews_by_customer(spark, written([], [])).isEmpty()


def test_only_sums_are_shuffled(spark, written):
    name = written(*random_rows(1, 0), buckets=8, parts=4)
    plan = colocated.reviews_by_customer(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # one exchange, of partial sums by customer, above the join of the two tables
    assert len(re.findall(r"\bExchange\b", plan)) == 1
    assert plan.index("Exchange") < plan.index("SortMergeJoin")


def test_hot_reviews_lie_in_many_buckets(spark, written):
    logs = [(7, user, "d", 1.0) for user in range(900)]
    logs += [(review, 1, "d", 1.0) for review in range(100, 200)]
    name = written([(7, 3, 1), (7, 3, 0), (100, 3, 1)], logs, buckets=8, parts=16)
    lines = spark.table(f"{name}_lines")
    sizes = lines.filter("id_review = 7").groupBy(colocated.PART).count().collect()
    assert len(sizes) == 16 and max(row["count"] for row in sizes) < 200
    assert lines.filter(f"id_review <> 7 and {colocated.PART} <> 0").isEmpty()
    assert spark.table(f"{name}_labels").filter("id_review = 7").count() == 16
    found = {r.customer_id: (r.review_count, r.review_score)
             for r in colocated.reviews_by_customer(spark, name).collect()}
    assert found[5] == (2, 1) and found[1] == (3, 2) and len(found) == 900
