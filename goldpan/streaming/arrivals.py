"""Waiting for input files, as a file stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from goldpan.operators.tables import location
from goldpan.schemas import USER_PURCHASE
from goldpan.sources.delimited import READ_OPTIONS, read_csv
from goldpan.sources.formats import write_options
from goldpan.sources.storage import (
    delete_path,
    list_children,
    part_files,
    path_exists,
    read_text,
    write_new_text,
)


def ingest_arrivals(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    fmt: str = "parquet",
    header: bool = True,
    line_breaks: bool = True,
    files_per_batch: int | None = None,
    timestamp_format: str | None = None,
) -> None:
    """Load every CSV file that arrived anywhere below ``landing`` since the last
    call, each exactly once.

    The checkpoint remembers which files are done and the sink's own log which
    output is complete, so a run that dies is continued and not repeated. Rows
    are only converted and written: no state is kept, whatever the volume.
    ``line_breaks=False`` promises that no field spans lines, so that large files
    are split. ``timestamp_format`` is as in ``read_csv``. Text sinks keep what datasets
    of their format keep: microseconds, blanks, nulls.
    """
    reader = (
        spark.readStream.schema(schema)
        .options(**READ_OPTIONS)
        .option("header", header)
        .option("multiLine", line_breaks)
        .option("recursiveFileLookup", True)
    )
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.csv(landing)
        .writeStream.format(fmt)
        .options(**write_options(fmt))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def load_arrivals(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: T.StructType = USER_PURCHASE,
    files_per_batch: int | None = None,
    **read: object,
) -> None:
    """Append every CSV file that arrived below ``landing`` to a typed table, each once.

    The stream only finds the files; a batch's files are read by :func:`read_csv` (with the
    options ``read``), large ones in splits, and inserted into the table, whose types and
    lengths are checked. A ledger beside the checkpoint holds, for the batch at work, the
    table's files before it. A batch that is in the ledger as done is not run again; one
    that began and did not end first takes away what it left. The stream is the table's
    only appender; a reload in between replaces what was loaded.
    """
    # the schema that Spark gives files as such; contents are not read
    files = "path string, modificationTime timestamp, length long, content binary"
    found = spark.readStream.format("binaryFile").schema(files)
    found = found.option("recursiveFileLookup", True)
    if files_per_batch:
        found = found.option("maxFilesPerTrigger", files_per_batch)
    ledger = f"{checkpoint.rstrip('/')}/ledger"

    def load(batch: DataFrame, number: int) -> None:
        paths = sorted(row.path for row in batch.collect())
        if paths and _begin(spark, ledger, number, table):
            read_csv(spark, paths, schema, **read).write.insertInto(table)
            write_new_text(spark, f"{ledger}/{number:020d}-done", "")

    query = (
        found.load(landing)
        .select("path")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _begin(spark: SparkSession, ledger: str, number: int, table: str) -> bool:
    """Whether the batch has to be loaded; the table then is as it was before the batch."""
    name = f"{ledger}/{number:020d}"
    if path_exists(spark, f"{name}-done"):
        return False
    where = location(spark, table)
    if path_exists(spark, f"{name}-begun"):
        begun = _begun(spark, f"{name}-begun")
        if begun and begun["location"] == where:
            for left in sorted(part_files(spark, where) - set(begun["files"])):
                delete_path(spark, f"{where}/{left}")
            spark.catalog.refreshTable(table)
            return True
        delete_path(spark, f"{name}-begun")
    for older in list_children(spark, ledger):
        delete_path(spark, older)
    before = {"location": where, "files": sorted(part_files(spark, where))}
    write_new_text(spark, f"{name}-begun", json.dumps(before) + "\n")
    return True


def _begun(spark: SparkSession, path: str) -> dict | None:
    """An entry, or None if it was cut short, in which case nothing was loaded yet."""
    text = read_text(spark, path)
    return json.loads(text) if text.endswith("\n") else None
