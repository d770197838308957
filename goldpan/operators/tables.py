"""Catalog tables with a fixed schema.

A table's rows live in a version folder below the table's root. Replacing or
clearing the rows fills a new version and then moves the table to it with one
catalog change, so readers see the old rows or the new ones, never a mix, and a
failed load leaves the table as it was.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.operators import counts
from goldpan.operators.changes import CHANGE, as_changes, changes
from goldpan.operators.load_report import LoadError, load_report
from goldpan.schemas import USER_PURCHASE, USER_PURCHASE_DDL
from goldpan.sources.delimited import read_csv, write_csv
from goldpan.sources.storage import delete_path, list_children

_ROOT = "goldpan.root"
KEPT_VERSIONS = 1


def create_table(
    spark: SparkSession,
    name: str,
    root: str,
    columns: str = USER_PURCHASE_DDL,
    fmt: str = "parquet",
) -> None:
    """Create the typed table unless it exists (T1). ``root`` must be shared storage.

    The table's versions lie in a folder of its own below ``root``, so that nothing else
    there is ever deleted with them.
    """
    own = f"{root.rstrip('/')}/table-{uuid.uuid4().hex}"
    if not fmt.isidentifier():
        raise ValueError(f"not a format name: {fmt!r}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING {fmt} "
        f"LOCATION :version TBLPROPERTIES ('{_ROOT}' = :root)",
        {"name": name, "version": _new_version(own), "root": own},
    )


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table and its rows if it exists."""
    root = _root(spark, name) if spark.catalog.tableExists(name) else None
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})
    if root:
        delete_path(spark, root)


def clear_table(spark: SparkSession, name: str) -> None:
    """Delete all rows."""
    _move_to_new_version(spark, name, lambda staged: None)


def reload_table(df: DataFrame, name: str, keep: int | None = KEPT_VERSIONS) -> None:
    """Make the table hold exactly the rows of ``df`` (T4); columns bind by position.

    Of the versions it has replaced, the table keeps the last ``keep`` for running
    readers (None: all). The version keeps the number and a checksum of its rows, both
    observed while they are written.
    """
    spark = df.sparkSession

    def fill(staged: str) -> None:
        written = counts.observed(df, spark.table(staged).schema)
        written.rows.write.insertInto(staged)
        counts.record(spark, location(spark, staged), written)

    _move_to_new_version(spark, name, fill)
    if keep is not None:
        remove_old_versions(df.sparkSession, name, keep)


def reload_changes(spark: SparkSession, name: str) -> DataFrame:
    """What the last reload changed: rows added and removed, with signed counts (T4).

    Compares the table's current version with the one it has replaced, which it still
    keeps. A table that was never reloaded, or keeps no old version, counts as new.
    """
    rows = spark.table(name)
    older = _older_versions(spark, name)
    if not older:
        return as_changes(rows).groupBy(*rows.columns).agg(F.sum(CHANGE).alias(CHANGE))
    provider = _describe(spark, name)["provider"]
    return changes(spark.read.schema(rows.schema).format(provider).load(older[-1]), rows)


def load_csv(spark: SparkSession, path: str, name: str, **read: object) -> None:
    """Append a CSV file to a typed table (S1, S4). Bad values: see :func:`reload_csv`."""
    with _reporting(spark, path, name, read):
        read_csv(spark, path, USER_PURCHASE, **read).write.insertInto(name)


def reload_csv(spark: SparkSession, path: str, name: str, **read: object) -> None:
    """Make the table equal to a CSV file, however often it runs (T4).

    A file with bad values leaves the table as it was and raises :class:`LoadError`, which
    tells all columns and reasons and not the first one alone (P3).
    """
    with _reporting(spark, path, name, read):
        reload_table(read_csv(spark, path, USER_PURCHASE, **read), name)


def report_csv(spark: SparkSession, path: str | list[str], name: str, **read: object) -> DataFrame:
    """Everything in CSV files that the table would refuse, see :func:`load_report`."""
    read.pop("layout", None)
    return load_report(spark, path, spark.table(name).schema, **read)


@contextmanager
def _reporting(spark: SparkSession, path: str, name: str, read: dict) -> Iterator[None]:
    """Only a load that fails pays for its report: one more pass over the file."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        if read.get("layout") == "files":
            raise  # such files may have lines that only that layout can read
        problems = report_csv(spark, path, name, **read).orderBy("column_name", "reason").collect()
        if problems:
            raise LoadError(path, problems, error) from error
        raise


def total_rows(df: DataFrame) -> DataFrame:
    """Row count as a one-row table (A1)."""
    return df.agg(F.count("*").alias("total_rows"))


def recorded_rows(spark: SparkSession, name: str) -> int | None:
    """The table's number of rows without a scan (A1), as its last reload observed it.

    None if there is no record, or rows were appended since. Files of the reload that are
    gone or have another size are an error.
    """
    found = counts.recorded(spark, location(spark, name))
    return found and found["rows"]


def table_rows(spark: SparkSession, name: str) -> DataFrame:
    """Row count of a table as a one-row table (A1): the recorded one, or else a scan's."""
    rows = recorded_rows(spark, name)
    if rows is None:
        return total_rows(spark.table(name))
    return spark.range(1).select(F.lit(rows).cast("long").alias("total_rows"))


def verify_table(spark: SparkSession, name: str) -> bool:
    """Scan the table and compare it with its record: an error where they differ.

    Tells whether there was a record of all its rows to compare with.
    """
    return counts.verify(spark, location(spark, name), spark.table(name))


def is_nonempty(df: DataFrame) -> bool:
    """The count-as-condition of the load and export steps (P6); stops at the first row."""
    return not df.isEmpty()


def export_if_nonempty(df: DataFrame, path: str, **write: object) -> bool:
    """CSV export of all rows (S2, T5). An empty table leaves an earlier export alone."""
    if not is_nonempty(df):
        return False
    write_csv(df, path, **write)
    return True


def remove_old_versions(spark: SparkSession, name: str, keep: int = 0) -> None:
    """Free the space of replaced versions but the last ``keep``.

    Run it while no load or long read is active that needs an older one.
    """
    old = _older_versions(spark, name)
    for version in old[: max(0, len(old) - keep)]:
        delete_path(spark, version)


def _older_versions(spark: SparkSession, name: str) -> list[str]:
    """Folders of the versions that were replaced and are kept, the oldest first."""
    current = _last_part(_describe(spark, name)["location"])
    versions = {_last_part(path): path for path in list_children(spark, _root(spark, name))}
    # names begin with the time, and a version made later than the current one is a
    # load that has not ended
    old = sorted(v for v in versions if v.startswith("version-") and v < current)
    return [versions[version] for version in old]


def location(spark: SparkSession, name: str) -> str:
    """The folder of the table's current rows."""
    return _describe(spark, name)["location"].rstrip("/")


def _last_part(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _move_to_new_version(spark: SparkSession, name: str, fill: Callable[[str], None]) -> None:
    version = _new_version(_root(spark, name))
    staged = f"goldpan_staged_{uuid.uuid4().hex}"
    try:
        # same columns and VARCHAR limits, so the insert is checked before it is visible
        spark.sql(
            "CREATE TABLE IDENTIFIER(:staged) LIKE IDENTIFIER(:name) LOCATION :version",
            {"staged": staged, "name": name, "version": version},
        )
        fill(staged)
        spark.sql(
            "ALTER TABLE IDENTIFIER(:name) SET LOCATION :version",
            {"name": name, "version": version},
        )
    except BaseException:
        delete_path(spark, version)
        raise
    finally:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:staged)", {"staged": staged})
    spark.catalog.refreshTable(name)


def _new_version(root: str) -> str:
    return f"{root.rstrip('/')}/version-{time.time_ns():020d}-{uuid.uuid4().hex}"


def _describe(spark: SparkSession, name: str) -> dict:
    described = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name) AS JSON", {"name": name})
    return json.loads(described.first()[0])


def _root(spark: SparkSession, name: str) -> str:
    properties = _describe(spark, name).get("table_properties", {})
    if _ROOT not in properties:
        raise ValueError(f"{name} was not made by create_table")
    return properties[_ROOT]
