from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime
from decimal import Decimal

import pytest

from goldpan.plans import gold, silver
from goldpan.plans import star_inputs as star
from goldpan.schemas import CLASSIFIED_REVIEW, REVIEW_LOGS, USER_PURCHASE
from goldpan.sources.formats import read_dataset, write_dataset
from tests.conftest import values

SMALL = "/root/testdata/sf0.001"


def purchase(customer, quantity, price):
    when = datetime(2020, 1, 1)
    return ("1", "1", "d", quantity, when, Decimal(price), customer, "x")


def brute_force(purchases, classified, logs):
    spent, reviews, scores = defaultdict(Decimal), Counter(), Counter()
    for row in purchases:
        amount = Decimal(0) if None in (row[3], row[5]) else row[3] * row[5]
        spent[row[6]] += amount
    for id_review, user, _, _ in logs:
        for other, _, positive in classified:
            if id_review == other and id_review is not None:
                reviews[user] += 1
                scores[user] += positive
    return sorted(
        (
            (customer, amount.quantize(Decimal("0.001")))
            + ((0, 0) if customer is None else (reviews[customer], scores[customer]))
            for customer, amount in spent.items()
        ),
        key=repr,
    )


def check(spark, purchases, classified, logs):
    result = gold.movie_analytics(
        spark.createDataFrame(purchases, USER_PURCHASE),
        spark.createDataFrame(classified, CLASSIFIED_REVIEW),
        spark.createDataFrame(logs, REVIEW_LOGS),
    )
    assert [f"{f.name} {f.dataType.simpleString()}" for f in result.schema] == [
        "customer_id int",
        "amount_spent decimal(18,3)",
        "review_count bigint",
        "review_score bigint",
    ]
    assert values(result) == brute_force(purchases, classified, logs)


def test_small_case(spark):
    check(
        spark,
        [purchase(1, 2, "1.500"), purchase(1, -1, "0.250"), purchase(2, 0, "9.999"),
         purchase(None, 1, "1.000")],
        [(10, 5, 1), (11, 3, 0), (12, 1, 1)],
        [(10, 1, "a", 0.1), (11, 1, "a", 0.1), (12, 3, "a", 0.1), (99, 2, "a", 0.1)],
    )


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_copies_and_missing_keys(spark, setting, broadcast):
    setting("spark.sql.autoBroadcastJoinThreshold", broadcast)
    rng = random.Random(broadcast)

    def key(highest):
        # a third of the rows share one key
        return rng.choice([1, None, rng.randint(1, highest), rng.randint(1, highest)])

    check(
        spark,
        [purchase(key(9), rng.randint(-5, 9), f"{rng.random():.3f}") for _ in range(200)],
        [(key(40), 3, rng.randint(0, 1)) for _ in range(120)],
        [(key(40), key(9), "a", 0.1) for _ in range(150)],
    )


def test_reviews_are_summed_before_the_join(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = _analytics_plan(spark)
    # classified by review, both sides into the join, reviews and purchases by customer
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("SortMergeJoin") == 2


def test_a_hot_review_is_split_in_the_join(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    setting("spark.sql.shuffle.partitions", "8")
    logs = spark.range(0, 60_000, 1, 16).selectExpr(
        "IF(id % 3 = 0, 7, id) AS id_review", "id % 1000 AS user_id",
        "'d' AS device", "0D AS score",
    )
    classified = spark.range(60_000).selectExpr(
        "id AS id_review", "1L AS n_words", "CAST(id % 2 AS INT) AS positive_review"
    )
    result = gold.reviews_by_customer(classified, logs)
    total = result.agg({"review_count": "sum"}).first()[0]
    assert total == 60_000
    rows = result.collect()
    assert len(rows) == 1000
    # the plan that ran, as adapted to the sizes it met
    assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


def test_scans_of_silver_read_only_what_gold_needs(spark, tmp_path):
    silver = {
        "purchases": spark.createDataFrame([purchase(1, 1, "1.000")], USER_PURCHASE),
        "classified": spark.createDataFrame([(1, 1, 1)], CLASSIFIED_REVIEW),
        "logs": spark.createDataFrame([(1, 1, "a", 0.5)], REVIEW_LOGS),
    }
    for name, rows in silver.items():
        write_dataset(rows, f"{tmp_path}/{name}")
    result = gold.movie_analytics(
        **{name: read_dataset(spark, f"{tmp_path}/{name}") for name in silver}
    )
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "struct<quantity:int,unit_price:decimal(8,3),customer_id:int>" in plan
    assert "struct<id_review:bigint,positive_review:int>" in plan
    assert "struct<id_review:bigint,user_id:bigint>" in plan
    assert plan.count("IsNotNull(id_review)") >= 2


def _analytics_plan(spark):
    result = gold.movie_analytics(
        spark.createDataFrame([purchase(1, 1, "1.000")], USER_PURCHASE),
        spark.createDataFrame([(1, 1, 1)], CLASSIFIED_REVIEW),
        spark.createDataFrame([(1, 1, "a", 0.5)], REVIEW_LOGS),
    )
    return result._jdf.queryExecution().executedPlan().toString()


def test_users_beyond_the_customers_type_match_nobody(spark):
    result = gold.movie_analytics(
        spark.createDataFrame([purchase(1, 1, "1.000")], USER_PURCHASE),
        spark.createDataFrame([(1, 1, 1)], CLASSIFIED_REVIEW),
        spark.createDataFrame([(1, 2**40 + 1, "a", 0.5), (1, 1, "a", 0.5)], REVIEW_LOGS),
    )
    assert [tuple(row)[2:] for row in result.collect()] == [(1, 1)]


def test_gold_parses_each_payload_once(spark):
    logs = silver.review_logs(star.log_reviews(spark, SMALL))
    classified = silver.classified_reviews(star.movie_reviews(spark, SMALL))
    result = gold.movie_analytics(silver.user_purchase(star.purchases(spark, SMALL)), classified, logs)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1
