"""Column contracts of the bronze, silver and gold datasets.

Evidence tags used in docstrings across the package:

* E - the behaviour is stated by the workflow this package replaces;
* I - inferred from a name, a path or a dependency;
* D - our own design choice where the original job body is not published.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The purchase table, names, types and order (E).
USER_PURCHASE_DDL = """
    invoice_number VARCHAR(10),
    stock_code VARCHAR(20),
    detail VARCHAR(1000),
    quantity INT,
    invoice_date TIMESTAMP_NTZ,
    unit_price DECIMAL(8,3),
    customer_id INT,
    country VARCHAR(20)
"""

# The same columns for file readers, which take plain strings; the table's own
# VARCHAR(n) limits are checked when rows are inserted.
USER_PURCHASE = T.StructType(
    [
        T.StructField("invoice_number", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("unit_price", T.DecimalType(8, 3)),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("country", T.StringType()),
    ]
)

# Bronze review files: the paths are E, the columns are D.
MOVIE_REVIEW = T.StructType(
    [
        T.StructField("id_review", T.LongType()),
        T.StructField("review_str", T.StringType()),
    ]
)
LOG_REVIEWS = T.StructType(
    [
        T.StructField("id_review", T.LongType()),
        T.StructField("log", T.StringType()),
    ]
)

# XML payload of ``log`` (D): the default, always replaceable by the caller.
LOG_PAYLOAD = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("device", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
LOG_ROW_TAG = "log"

# Silver review sets (D).
REVIEW_LOGS = T.StructType(
    [
        T.StructField("id_review", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("device", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
CLASSIFIED_REVIEW = T.StructType(
    [
        T.StructField("id_review", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("positive_review", T.IntegerType()),
    ]
)
