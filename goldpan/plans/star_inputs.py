"""Purchase and review inputs derived from a star schema of parquet tables.

Stands in for the raw files, which are not published. Nothing is broadcast by
hint: Spark does so only when a side's size allows it, and AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.functions.xml import build_xml
from goldpan.schemas import LOG_ROW_TAG


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """One purchase per order line, in the columns of the purchase table.

    Everything known per order or per part is joined and converted there, so the
    order lines, by far the largest table, go through two joins and no more.
    Orders and their lines grow together, so that join always shuffles.
    """
    lines, orders, parts, customers, nations = (
        table(spark, folder, name)
        for name in ("lineitem", "orders", "part", "customer", "nation")
    )
    countries = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("country")
    )
    placed = orders.join(countries, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("o_orderdate").alias("invoice_date"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        "country",
    )
    priced = parts.select(
        "p_partkey",
        F.col("p_name").alias("detail"),
        F.col("p_retailprice").cast("decimal(8,3)").alias("unit_price"),
    )
    return (
        lines.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(priced, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("invoice_number"),
            F.col("l_partkey").cast("string").alias("stock_code"),
            "detail",
            F.col("l_quantity").cast("int").alias("quantity"),
            "invoice_date",
            "unit_price",
            "customer_id",
            "country",
        )
    )


def log_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Review logs with an XML payload, one per event."""
    payload = F.struct(
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("device"),
        F.col("value").alias("score"),
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id_review"), build_xml(payload, LOG_ROW_TAG).alias("log")
    )


def movie_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with free text, one per document."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id_review"), F.col("text").alias("review_str")
    )


def review_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Known 0/1 labels of some reviews."""
    return table(spark, folder, "labels").select(
        F.col("doc_id").alias("id_review"), F.col("quality").alias("label")
    )
