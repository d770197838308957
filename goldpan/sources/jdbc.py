"""Relational tables over JDBC.

Reads and writes go straight between executors and the database. Without a split
one task would read the whole table, so a read has to name one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Column types of the purchase table as the database declares them (E).
USER_PURCHASE_JDBC_TYPES = (
    "invoice_number VARCHAR(10), stock_code VARCHAR(20), detail VARCHAR(1000), "
    "quantity INTEGER, invoice_date TIMESTAMP, unit_price DECIMAL(8,3), "
    "customer_id INTEGER, country VARCHAR(20)"
)


@dataclass(frozen=True)
class Stride:
    """Split a read by ranges of one column. The bounds only place the cuts: rows
    outside them and nulls are read too."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_options(stride: Stride | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {"fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    if stride is not None:
        options |= {
            "partitionColumn": stride.column,
            "lowerBound": str(stride.lower),
            "upperBound": str(stride.upper),
            "numPartitions": str(stride.partitions),
        }
    return options


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    stride: Stride | None = None,
    predicates: Sequence[str] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """``select *`` of a table, in parallel.

    ``predicates`` must be disjoint and cover all rows; they suit a table where
    one value of every candidate column holds a large share of the rows.
    """
    if (stride is None) == (predicates is None):
        raise ValueError("pass either stride or predicates")
    options = {**read_options(stride), **(properties or {})}
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    column_types: str | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> None:
    """Insert all rows in batches. ``mode="overwrite"`` truncates, so the table's
    own column types stay. ``connections`` bounds the load on the database, not the tasks
    that make the rows: those are dealt out once more to be written."""
    options = {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": "true",
        **(properties or {}),
    }
    if column_types:
        options["createTableColumnTypes"] = column_types
    dealt(df, connections).write.format("jdbc").options(**options).mode(mode).save()


def dealt(df: DataFrame, connections: int) -> DataFrame:
    """The rows in as many partitions as connections. Left to the writer, they would be
    put together without a shuffle, and the whole query would run in that few tasks."""
    return df.repartition(connections)
