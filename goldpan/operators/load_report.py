"""What is wrong with CSV files that cannot be loaded.

A strict load ends at its first bad value. Here all rows are read once more, every value
that the load would refuse becomes a problem (its column and the reason), and problems are
counted before they are shuffled: the report has one row for each column and reason,
whatever the number of rows. The same CSV parser tells good from bad as in the load: a value
is bad if it is there in a parse of texts and null in a parse of types.
"""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.sources.delimited import READ_OPTIONS, to_ddl
from goldpan.sources.records import read_quoted_records
from goldpan.sources.storage import reading_options

WRONG_LENGTH = "wrong number of fields"
EXAMPLE_CHARS = 100
_BAD_RECORD = "goldpan_bad_record"
# Fixed value: where Spark keeps a column's declared VARCHAR(n)
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


class LoadError(PySparkException):
    """A load that failed, with the rows of its report and the error that ended it."""

    def __init__(self, path: str | list[str], problems: list[T.Row], error: Exception):
        told = [
            f"{row.column_name or 'rows'}: {row.reason} ({row.n_rows} rows in {row.n_files} files, "
            f"such as {row.example!r} in {row.file})"
            for row in problems
        ]
        super().__init__(f"{path} cannot be loaded; " + "; ".join(told) + f"\n{error}")
        self.problems = problems


def varchar_limit(field: T.StructField) -> int | None:
    """The n of a column that a table declares as VARCHAR(n)."""
    declared = re.fullmatch(r"varchar\((\d+)\)", field.metadata.get(_DECLARED, ""))
    return int(declared[1]) if declared else None


def _problem(field: T.StructField) -> Column:
    """The problem with one value, or null."""
    value = F.col("raw").getField(field.name)
    typed = F.col("typed").getField(field.name)
    reason = F.when(
        value.isNotNull() & typed.isNull(), F.lit(f"not a {field.dataType.simpleString()}")
    )
    limit = varchar_limit(field)
    if limit is not None:
        # an insert cuts blanks at the end that are over the limit
        reason = reason.when(F.length(F.rtrim(value)) > limit, F.lit(f"longer than {limit}"))
    found = F.struct(
        F.lit(field.name).alias("column_name"), reason.alias("reason"), value.alias("value")
    )
    return F.when(reason.isNotNull(), found)


def load_report(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    timestamp_format: str | None = None,
) -> DataFrame:
    """``column_name, reason, n_rows, n_files, file, example`` for all values a load refuses.

    ``schema`` is that of the typed table, whose VARCHAR limits count. A row with too few
    or too many fields is one problem of no column (null). ``file`` is one of the files and
    ``example`` the least bad value there is, cut to ``EXAMPLE_CHARS``. Files without a
    problem, and empty ones, give an empty report; a quoted field that is never closed is
    an error, as in the load.
    """
    options = READ_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_RECORD}
    if timestamp_format:
        options["timestampNTZFormat"] = timestamp_format
    version = reading_options(spark, path) if isinstance(path, str) else {}
    bad = T.StructField(_BAD_RECORD, T.StringType())
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [bad])
    types = T.StructType([*schema.fields, bad])
    rows = read_quoted_records(spark, path, header, version, with_file=True).select(
        "file",
        "record",
        F.from_csv("record", to_ddl(texts), options).alias("raw"),
        F.from_csv("record", to_ddl(types), options).alias("typed"),
    )
    whole = F.struct(
        F.lit(None).cast("string").alias("column_name"),
        F.lit(WRONG_LENGTH).alias("reason"),
        F.col("record").alias("value"),
    )
    # texts always convert, so what is wrong with their record is its length
    by_column = F.array_compact(F.array(*map(_problem, schema.fields)))
    problems = F.when(F.col("raw").getField(_BAD_RECORD).isNotNull(), F.array(whole))
    found = rows.select("file", F.explode(problems.otherwise(by_column)).alias("problem"))
    found = found.select("file", "problem.column_name", "problem.reason", "problem.value")
    example = F.min(F.left("value", F.lit(EXAMPLE_CHARS)))
    per_file = found.groupBy("column_name", "reason", "file").agg(
        F.count("*").alias("n"), example.alias("example")
    )
    report = per_file.groupBy("column_name", "reason").agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_files"),
        F.min("file").alias("code"),
        F.min("example").alias("example"),
    )
    names = spark.read.options(**version).text(path)
    names = names.select(F.col("_metadata.file_path").alias("file")).distinct()
    names = names.withColumn("code", F.xxhash64("file"))
    return report.join(names, "code").select(
        "column_name", "reason", "n_rows", "n_files", "file", "example"
    )
