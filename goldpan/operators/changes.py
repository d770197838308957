"""What a reload changed, as signed rows, and sums that follow such changes.

Purchases have no key, so a change set is a difference of multisets: each distinct row with
the number of copies added (positive) or removed (negative).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "change"


def row_code(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row. A null is told apart from the value beside it."""
    parts: list[Column] = []
    for name in columns:
        column = F.col(f"`{name}`")
        parts += [column.isNull(), column]
    return [F.xxhash64(*parts).alias("code"), F.xxhash64(F.lit(1), *parts).alias("code2")]


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of either side with ``change`` <> 0; columns bind by position.

    Rows are compared by their hashes first: of rows that stay, only 128 bits and a count
    are shuffled, and equal ones are counted before. Whole rows move where a hash's count
    differs, and these are compared by all their columns.
    """
    names = old.columns
    signed = old.withColumn(CHANGE, F.lit(-1)).unionAll(
        new.toDF(*names).withColumn(CHANGE, F.lit(1))
    )
    coded = signed.select("*", *row_code(names))
    differing = coded.groupBy("code", "code2").agg(F.sum(CHANGE).alias("total"))
    differing = differing.filter("total <> 0").select("code", "code2")
    rows = coded.join(differing, ["code", "code2"], "left_semi")
    total = F.sum(CHANGE).cast("long").alias(CHANGE)
    return rows.groupBy(*(f"`{name}`" for name in names)).agg(total).filter(f"{CHANGE} <> 0")


def as_changes(rows: DataFrame) -> DataFrame:
    """All rows of a table as added to an empty one."""
    return rows.withColumn(CHANGE, F.lit(1).cast("long"))
