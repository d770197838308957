"""CSV in and out with the rules of a relational bulk load.

Contract of the load (E): comma-delimited, one header line that is skipped and
not matched, columns bound by position, every value converted to the column's
type, and one bad value or row fails the whole load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.sources import records
from goldpan.sources.storage import publish, reading_options

# Text formats otherwise cut timestamps to milliseconds.
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Fixed value: timestamps like 12/1/2010 8:26, which a database set to month-first
# dates takes as well.
MONTH_FIRST_TIMESTAMPS = "M/d/yyyy H:mm[:ss]"

# Doubled quotes, and an unquoted empty field (null) told apart
# from a quoted one (empty string). The null marker is NUL, the one character that
# a database text cannot hold.
READ_OPTIONS = {
    "escape": '"',
    "mode": "FAILFAST",
    "emptyValue": "",
    "nullValue": "\u0000",
}
WRITE_OPTIONS = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
}

# A file whose records contain line breaks is read by one task, so exports are
# cut into files of this many rows and stay parallel when they are read back.
DEFAULT_ROWS_PER_FILE = 1_000_000

# Fixed value: purchases take a quarter of their space at the quickest level already, which
# needs a third of the usual level's time.
_COMPRESSION_OPTIONS = {"gzip": {"zlib.compress.level": "BEST_SPEED"}}

# One exact layout for files of every size, read in ordinary splits; see read_csv.
DEFAULT_LAYOUT = "records"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    layout: str = DEFAULT_LAYOUT,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Typed, all-or-nothing CSV scan of a file, a folder, or a list of files.

    Timestamps are ISO unless ``timestamp_format`` says otherwise, for instance
    :data:`MONTH_FIRST_TIMESTAMPS`.

    ``layout`` says how files are read:

    * ``"records"`` - the default, for files of every size: the files' quotes are scanned
      when the reader is made (one pass that moves no text), then records are read in
      ordinary splits, by the CSV reader itself where no field holds a line break;
    * ``"files"`` - one task per file and no scan; the one layout that takes lines that
      end in a carriage return alone;
    * ``"lines"`` - no field holds a line break and no line is of blanks alone, on the
      caller's word; split freely and no scan.
    """
    options = dict(READ_OPTIONS)
    if timestamp_format:
        options["timestampNTZFormat"] = timestamp_format
    version = reading_options(spark, path) if isinstance(path, str) else {}
    if layout == "records":
        found = records.scan(spark, path, header, version)
        if not found.lines_are_records:
            parsed = F.from_csv("record", to_ddl(schema), options)
            texts = records.read_quoted_records(spark, path, header, version, found)
            return texts.select(parsed.alias("row")).select("row.*")
        layout = "lines"
    if layout not in ("lines", "files"):
        raise ValueError(f"layout must be lines, files or records, not {layout!r}")
    return (
        spark.read.schema(schema)
        .options(**options, **version)
        .option("header", header)
        .option("multiLine", layout == "files")
        .csv(path)
    )


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    compression: str | None = None,
    add: bool = False,
) -> None:
    """Whole-result CSV export: header names from the columns, quotes only where needed.

    ``path`` becomes a folder of part files, each with the header. Every task
    writes its own, so nothing passes through one process. ``compression`` is one that
    Spark's writer knows, such as ``gzip``; such a file is read by one task. With ``add`` an
    earlier export's rows stay beside the new ones.
    """
    writer = df.write.options(**WRITE_OPTIONS).option("header", header)
    if compression:
        options = _COMPRESSION_OPTIONS.get(compression.lower(), {})
        writer = writer.options(compression=compression, **options)
    writer = writer.option("maxRecordsPerFile", rows_per_file).mode("append")
    publish(df.sparkSession, path, writer.csv, add)


def to_ddl(schema: T.StructType) -> str:
    """The schema as text, for functions that take no other."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
