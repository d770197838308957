"""Row counts and checksums of a table's version as by-products of its write.

The write observes how many rows go through it and the sum of their hashes, so no scan
follows. Both are kept in a small file in the version's own folder, with the sizes of the
files that the write has made, in sum and by hash. A later reader compares the folder's
listing with that before it believes the count.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.operators.load_report import varchar_limit
from goldpan.sources.storage import part_files, path_exists, read_text, write_job, write_new_text

_RECORD = "_goldpan-counts"
_PART = 21


@dataclass
class Observed:
    """Rows that are counted by the action that writes them."""

    rows: DataFrame
    seen: Observation


def _hashed(schema: T.StructType) -> Column:
    """A row's hash over the values the table stores. Maps have none and are left out."""
    parts: list[Column] = [F.lit(0)]
    for field in schema.fields:
        if "map<" in field.dataType.simpleString():
            continue
        value = F.col(f"`{field.name}`").cast(field.dataType)
        limit = varchar_limit(field)
        if limit is not None:
            value = F.substring(value, 1, limit)  # an insert cuts blanks over the limit
        parts += [value.isNull(), value]
    return F.xxhash64(*parts)


def _metrics(schema: T.StructType) -> list[Column]:
    """Sums of hashes tell repeated rows from missing ones, in any order.

    A hash is summed in three parts of some 21 bits, as whole numbers that hold 2 ** 41 rows
    and need no decimal for each row.
    """
    code = _hashed(schema)
    checksum = F.lit(0).cast("decimal(38,0)")
    for shift in (2 * _PART, _PART, 0):
        part = F.shiftright(code, shift)
        if shift < 2 * _PART:
            part = part.bitwiseAND((1 << _PART) - 1)
        total = F.coalesce(F.sum(part), F.lit(0)).cast("decimal(19,0)")
        checksum = checksum + total * F.lit(1 << shift).cast("decimal(13,0)")
    checksum = checksum.cast("decimal(38,0)").cast("string")
    return [F.count(F.lit(1)).alias("rows"), checksum.alias("checksum")]


def observed(df: DataFrame, schema: T.StructType) -> Observed:
    """``df``, whose columns bind to the table's ``schema`` by position, under observation."""
    seen = Observation()
    if len(df.columns) == len(schema.fields):
        df = df.toDF(*schema.names)
        return Observed(df.observe(seen, *_metrics(schema)), seen)
    return Observed(df, seen)  # the insert refuses it


def _files(spark: SparkSession, folder: str, job: str) -> dict:
    """Number, bytes and a hash of a write job's files, by their listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"part-*{job}*").load(folder)
    name = F.substring_index("path", "/", -1)
    row = files.agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.sum(F.xxhash64(name, "length").cast("decimal(28,0)")).cast("string").alias("listing"),
    ).first()
    return row.asDict()


def record(spark: SparkSession, folder: str, written: Observed) -> None:
    """Keep what the write into ``folder``, a new version, has observed."""
    jobs = {write_job(name) for name in part_files(spark, folder)}
    if len(jobs) > 1 or None in jobs:
        return  # not one write's files
    job = jobs.pop() if jobs else None
    listed = _files(spark, folder, job) if job else {}
    found = written.seen.get | {"job": job} | listed
    write_new_text(spark, f"{folder}/{_RECORD}", json.dumps(found) + "\n")


def recorded(spark: SparkSession, folder: str) -> dict | None:
    """The record, if the folder holds just what it tells of; see ``recorded_rows``."""
    path = f"{folder}/{_RECORD}"
    if not path_exists(spark, path):
        return None
    text = read_text(spark, path)
    if not text.endswith("\n"):
        return None
    found = json.loads(text)
    job = found["job"]
    if job:
        now = _files(spark, folder, job)
        if any(found[key] != now[key] for key in now):
            raise OSError(f"files of {folder} were changed or deleted since they were written")
    if {write_job(name) for name in part_files(spark, folder)} - {job}:
        return None
    return found


def verify(spark: SparkSession, folder: str, rows: DataFrame) -> bool:
    """Compare all rows with the record; False where there is none."""
    found = recorded(spark, folder)
    if found is None:
        return False
    now = rows.agg(*_metrics(rows.schema)).first().asDict()
    if any(found[key] != now[key] for key in now):
        raise OSError(f"{folder} holds other rows than were written: {now} instead of {found}")
    return True
