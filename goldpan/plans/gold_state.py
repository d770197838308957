"""Gold kept up to date by signed changes, without a full recomputation (J4, D).

The state has mergeable sums per customer. A change set (``operators/changes.py``) adds to
them: purchases by themselves, reviews and their logs through the join of one side's changes
with the other side. Customers whose purchases are all gone leave the gold table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.operators.changes import CHANGE

# sums by customer: purchases, those with a quantity and a price, their amount, and what
# the customer's log lines meet
STATE = ("purchases", "priced", "amount", "review_count", "review_score")
_AMOUNT = "decimal(38,3)"


def _sum(column: Column, kind: str, name: str) -> Column:
    return F.sum(column).cast(kind).alias(name)


def _nothing(*names: str) -> list[Column]:
    return [F.lit(0).cast(_AMOUNT if name == "amount" else "long").alias(name) for name in names]


def purchase_deltas(changed: DataFrame) -> DataFrame:
    """Sums of ``purchases`` rows with a signed ``change``."""
    amount = F.col("quantity") * F.col("unit_price")
    sums = changed.groupBy(F.col("customer_id").cast("bigint").alias("customer_id")).agg(
        _sum(F.col(CHANGE), "long", "purchases"),
        _sum(F.when(amount.isNotNull(), F.col(CHANGE)).otherwise(0), "long", "priced"),
        F.coalesce(_sum(amount * F.col(CHANGE), _AMOUNT, "a"), F.lit(0).cast(_AMOUNT)).alias("amount"),
    )
    return sums.select("customer_id", *STATE[:3], *_nothing(*STATE[3:]))


def review_deltas(classified: DataFrame, logs: DataFrame) -> DataFrame:
    """Sums of signed reviews met by signed log lines.

    Reviews are summed per id before the join. Joining on the id and a value derived from
    it lets AQE split a review that most lines name, as in the full gold.
    """
    labels = classified.groupBy(F.col("id_review").alias("labelled")).agg(
        F.sum(CHANGE).alias("n"), F.sum(F.col("positive_review") * F.col(CHANGE)).alias("positive")
    )
    lines = logs.select(F.col("user_id").alias("customer_id"), "id_review", CHANGE)
    same = (F.col("id_review") == F.col("labelled")) & (
        F.xxhash64("id_review") == F.xxhash64("labelled")
    )
    sums = lines.join(labels, same).groupBy("customer_id").agg(
        _sum(F.col("n") * F.col(CHANGE), "long", "review_count"),
        F.coalesce(_sum(F.col("positive") * F.col(CHANGE), "long", "s"), F.lit(0)).alias("review_score"),
    )
    return sums.select("customer_id", *_nothing(*STATE[:3]), *STATE[3:])


def merged(*states: DataFrame) -> DataFrame:
    """The sum of states and deltas, in any order; customers without any rows are left out."""
    both = states[0]
    for other in states[1:]:
        both = both.unionByName(other)
    kinds = {name: _AMOUNT if name == "amount" else "long" for name in STATE}
    sums = both.groupBy("customer_id").agg(*(_sum(F.col(n), kinds[n], n) for n in STATE))
    nonzero = [F.col(name) != 0 for name in STATE]
    return sums.filter(nonzero[0] | nonzero[1] | nonzero[2] | nonzero[3] | nonzero[4])


def apply_changes(
    state: DataFrame,
    purchases: DataFrame | None = None,
    classified: DataFrame | None = None,
    logs: DataFrame | None = None,
    classified_before: DataFrame | None = None,
    logs_after: DataFrame | None = None,
) -> DataFrame:
    """The state after signed changes of any of the three silver sets.

    Changed logs meet the reviews as they were before, changed reviews the logs as they are
    after, so that a line and a review that change together count once.
    """
    deltas = [state]
    if purchases is not None:
        deltas.append(purchase_deltas(purchases))
    if logs is not None:
        deltas.append(review_deltas(classified_before, logs))
    if classified is not None:
        deltas.append(review_deltas(classified, logs_after))
    return merged(*deltas)


def gold_of(state: DataFrame) -> DataFrame:
    """The gold table that the state stands for."""
    amount = F.when(F.col("priced") > 0, F.col("amount")).cast("decimal(18,3)")
    # as in the full gold, customers without an id meet no reviews
    met = F.col("customer_id").isNotNull()
    return state.filter("purchases > 0").select(
        F.col("customer_id").cast("int").alias("customer_id"),
        amount.alias("amount_spent"),
        F.when(met, F.col("review_count")).otherwise(0).cast("long").alias("review_count"),
        F.when(met, F.col("review_score")).otherwise(0).cast("long").alias("review_score"),
    )
