"""Log lines and review labels side by side in buckets.

Gold joins every log line to its review. Written once in buckets of the review's id, both
sides are joined bucket by bucket, run after run, and neither of them is shuffled again.

A review with a large share of all lines would make one bucket, hence one task, of them all.
Its lines are therefore dealt over ``parts`` of it, and its label is there once for each part.
Reviews are split when they have more lines than an average bucket holds, so there are
fewer such reviews than buckets and their labels add ``buckets * parts`` rows at most.

Purchases are not kept in buckets: they are summed by customer before they are shuffled, so
a customer with a third of all rows costs one row per task, not a bucket of its own.

Defined results: lines and reviews without an id are kept and meet nothing; copies of a
review's row are counted together; empty inputs give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.plans.gold import review_sums

BUCKETS = 256
PARTS = 32
PART = "review_part"


def write_colocated(
    classified: DataFrame,
    logs: DataFrame,
    name: str,
    root: str,
    buckets: int = BUCKETS,
    parts: int = PARTS,
) -> tuple[str, str]:
    """Replace the tables ``<name>_lines`` and ``<name>_labels`` below ``root``; their names.

    ``root`` must be shared storage. Lines are read twice: to count them, and to write them.
    Take as many ``buckets`` as make one of them a task's work. The tables are derived: after
    a write that fails they are missing or half there, and are to be written again.
    """
    spark = logs.sparkSession
    split = _split_reviews(logs, buckets)
    lines, labels = f"{name}_lines", f"{name}_labels"
    # a line's part follows from its values and its input split, so a task that is run
    # again deals the same lines to the same parts
    values = [f.name for f in logs.schema.fields if not _holds_map(f.dataType)]
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *values), F.lit(parts)).cast("int")
    marked = logs.withColumn("__dealt", dealt).join(F.broadcast(split), "id_review", "left")
    is_split = F.col("__split").isNotNull() | F.col("id_review").isNull()
    part = F.when(is_split, F.col("__dealt")).otherwise(0)
    _write_buckets(
        marked.select(*logs.columns, part.alias(PART)), lines, f"{root}/lines", buckets
    )
    sums = review_sums(classified).join(F.broadcast(split), "id_review", "left")
    every = F.sequence(F.lit(0), F.when(F.col("__split"), parts - 1).otherwise(0))
    _write_buckets(
        sums.select("id_review", "n", "positive", F.explode(every).alias(PART)),
        labels,
        f"{root}/labels",
        buckets,
    )
    return lines, labels


def reviews_by_customer(spark: SparkSession, name: str) -> DataFrame:
    """The review half of gold from the two tables: only its sums are shuffled."""
    lines, labels = spark.table(f"{name}_lines"), spark.table(f"{name}_labels")
    # merged, as each bucket is a partition on both sides already
    return (
        lines.select(F.col("user_id").alias("customer_id"), "id_review", PART)
        .join(labels.hint("merge"), ["id_review", PART])
        .groupBy("customer_id")
        .agg(F.sum("n").alias("review_count"), F.sum("positive").alias("review_score"))
    )


def _split_reviews(logs: DataFrame, buckets: int) -> DataFrame:
    """``id_review, __split`` of reviews with more lines than a bucket's average: fewer
    than ``buckets`` rows, whatever the input."""
    counted = logs.groupBy("id_review").agg(F.count("*").alias("n"))
    total = logs.agg((F.count("*") / buckets).alias("average"))
    large = counted.filter(F.col("id_review").isNotNull()).join(
        F.broadcast(total), F.col("n") > F.greatest("average", F.lit(1))
    )
    rows = large.select("id_review", F.lit(True).alias("__split"))
    # found once, as both tables have to agree on it
    return logs.sparkSession.createDataFrame(rows.collect(), rows.schema)


def _write_buckets(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    # dealt like the buckets themselves, so that each bucket is one file
    spark = rows.sparkSession
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": table})
    (
        rows.repartition(buckets, "id_review", PART)
        .write.bucketBy(buckets, "id_review", PART)
        .sortBy("id_review", PART)
        .format("parquet")
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(table)
    )


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind.fields)
    return isinstance(kind, T.MapType)
