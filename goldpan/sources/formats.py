"""Datasets in a format chosen by name (S8-S10) and a look at their first rows.

The format name is passed on as given (E), so any data source on the classpath
works. ``avro`` needs its Spark module; the other names below are built in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from goldpan.sources.delimited import (
    DEFAULT_ROWS_PER_FILE,
    READ_OPTIONS,
    TIMESTAMP_NTZ_FORMAT,
    WRITE_OPTIONS,
    read_csv,
)
from goldpan.sources.storage import publish, reading_options

DEFAULT_FORMAT = "parquet"
BUILT_IN_FORMATS = ("parquet", "orc", "json", "csv", "xml")

# What each text format needs to keep every value. Files of csv, json and
# xml may have to be read by one task each, so they are kept small. Names of fields and
# tags in every row make most of json and xml: compressed, a tenth of it is written.
_WRITE = {
    "csv": {**WRITE_OPTIONS, "header": "true", "maxRecordsPerFile": DEFAULT_ROWS_PER_FILE},
    "json": {
        "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
        "ignoreNullFields": "false",
        "compression": "gzip",
        # a row takes about twice the space it takes in csv
        "maxRecordsPerFile": DEFAULT_ROWS_PER_FILE // 2,
    },
    "xml": {
        "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
        "rowTag": "row",
        "rootTag": "rows",
        "compression": "gzip",
        # a row takes about four times the space it takes in csv
        "maxRecordsPerFile": DEFAULT_ROWS_PER_FILE // 4,
    },
}
_READ = {
    "csv": {**READ_OPTIONS, "header": "true", "multiLine": "true"},
    "json": {"timestampNTZFormat": TIMESTAMP_NTZ_FORMAT, "mode": "FAILFAST"},
    "xml": {
        "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
        "rowTag": "row",
        "mode": "FAILFAST",
        "ignoreSurroundingSpaces": "false",
    },
}


def write_options(fmt: str) -> dict[str, object]:
    """What a format's writer needs to keep every value."""
    return dict(_WRITE.get(fmt.lower(), {}))


def write_dataset(
    df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, rows_per_file: int | None = None
) -> None:
    """Replace the dataset at ``path``; an earlier one survives a failed write."""
    spark = df.sparkSession
    writer = df.write.format(fmt).options(**write_options(fmt))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    with_hint = _naming_missing_module(spark, fmt)
    writer = writer.mode("append")
    publish(spark, path, lambda folder: with_hint(lambda: writer.save(folder)))


def read_dataset(
    spark: SparkSession,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan a dataset; text formats carry no types, so pass their schema."""
    if fmt.lower() == "csv" and schema is not None:
        return read_csv(spark, path, schema)
    reader = spark.read.format(fmt).options(**_READ.get(fmt.lower(), {}))
    reader = reader.options(**reading_options(spark, path))
    if schema is not None:
        reader = reader.schema(schema)
    return _naming_missing_module(spark, fmt)(lambda: reader.load(path))


def show_table(
    spark: SparkSession,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    n: int = 20,
    schema: T.StructType | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """First ``n`` rows. With ``order_by`` the same rows every time, as a top-n
    per task merged at the end, never a full sort."""
    rows = read_dataset(spark, path, fmt, schema)
    if order_by:
        rows = rows.orderBy(*order_by)
    return rows.limit(int(n))


def _naming_missing_module(spark: SparkSession, fmt: str):
    def run(action):
        try:
            return action()
        except AnalysisException as error:
            if fmt.lower() != "avro":
                raise
            raise ValueError(
                "format avro needs the Spark module: start the session with "
                f"--packages org.apache.spark:spark-avro_2.13:{spark.version} ({error})"
            ) from error

    return run
