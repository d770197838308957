"""Reports of refused values, and counts that writes leave behind."""

from __future__ import annotations

from pathlib import Path

import pytest

from goldpan.operators import tables
from goldpan.operators.load_report import EXAMPLE_CHARS, WRONG_LENGTH, LoadError
from goldpan.sources.delimited import MONTH_FIRST_TIMESTAMPS, read_csv
from tests import samples
from tests.conftest import JOB_ERRORS, values


@pytest.fixture
def purchases(spark, tmp_path, table_name):
    tables.create_table(spark, table_name, f"{tmp_path}/tables/{table_name}")
    return table_name


@pytest.fixture
def good_csv(tmp_path):
    path = tmp_path / "good.csv"
    path.write_text(samples.GOOD_FILE)
    return str(path)


BAD_LINES = (
    samples.line(quantity="six", country="x" * 21),
    samples.line(quantity="7.5"),
    samples.line(invoice_date="yesterday", unit_price="999999.999"),
    samples.line(detail='"' + "y" * 900 + "\n" + "y" * 900 + '"'),
    "short,row",
    samples.GOOD_LINE + ",more",
    samples.line(country="France" + " " * 30),  # blanks over the limit are cut, not refused
    samples.line(quantity='""'),
    samples.line(quantity=""),
)
PROBLEMS = {
    ("quantity", "not a int"): (3, ""),
    ("country", "longer than 20"): (1, "x" * 21),
    ("invoice_date", "not a timestamp_ntz"): (1, "yesterday"),
    ("unit_price", "not a decimal(8,3)"): (1, "999999.999"),
    ("detail", "longer than 1000"): (1, "y" * EXAMPLE_CHARS),
    (None, WRONG_LENGTH): (2, (samples.GOOD_LINE + ",more")[:EXAMPLE_CHARS]),
}


def _told(rows):
    return {(row.column_name, row.reason): (row.n_rows, row.example) for row in rows}


def test_all_problems_are_told_with_their_file(spark, purchases, tmp_path, good_csv):
    bad = samples.write(tmp_path / "bad file.csv", samples.GOOD_LINE, *BAD_LINES)
    rows = tables.report_csv(spark, [good_csv, bad], purchases).collect()
    assert _told(rows) == PROBLEMS
    assert {row.n_files for row in rows} == {1}
    assert all(row.file.endswith("bad%20file.csv") for row in rows)


def test_small_splits_tell_the_same(spark, purchases, tmp_path, setting):
    bad = samples.write(tmp_path / "bad.csv", samples.GOOD_LINE, *BAD_LINES)
    setting("spark.sql.files.maxPartitionBytes", "64")
    setting("spark.sql.files.openCostInBytes", "0")
    assert _told(tables.report_csv(spark, bad, purchases).collect()) == PROBLEMS


def test_files_are_counted(spark, purchases, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for number in range(3):
        samples.write(folder / f"{number}.csv", samples.line(quantity="x"), samples.line(quantity="y"))
    (row,) = tables.report_csv(spark, str(folder), purchases).collect()
    assert (row.column_name, row.n_rows, row.n_files, row.example) == ("quantity", 6, 3, "x")


def test_what_loads_has_no_problem(spark, purchases, tmp_path, good_csv):
    assert tables.report_csv(spark, good_csv, purchases).isEmpty()
    assert tables.report_csv(spark, samples.write(tmp_path / "empty.csv"), purchases).isEmpty()
    path = samples.write(tmp_path / "us.csv", samples.line(invoice_date="12/1/2010 8:26"))
    assert not tables.report_csv(spark, path, purchases).isEmpty()
    us = {"timestamp_format": MONTH_FIRST_TIMESTAMPS}
    assert tables.report_csv(spark, path, purchases, **us).isEmpty()


@pytest.mark.parametrize("load", [tables.load_csv, tables.reload_csv])
def test_a_failed_load_tells_all_and_changes_nothing(spark, purchases, tmp_path, good_csv, load):
    tables.reload_csv(spark, good_csv, purchases)
    before = values(spark.table(purchases))
    bad = samples.write(tmp_path / "bad.csv", samples.GOOD_LINE, *BAD_LINES)
    with pytest.raises(LoadError) as raised:
        load(spark, bad, purchases)
    assert _told(raised.value.problems) == PROBLEMS
    assert "quantity: not a int (3 rows in 1 files" in str(raised.value)
    spark.catalog.refreshTable(purchases)
    assert values(spark.table(purchases)) == before


def test_other_failures_stay_what_they_are(spark, purchases, tmp_path):
    with pytest.raises(JOB_ERRORS) as raised:
        tables.reload_csv(spark, f"{tmp_path}/not-there.csv", purchases)
    assert not isinstance(raised.value, LoadError)


# --- counts ---------------------------------------------------------------------


def _parts(spark, name):
    folder = Path(tables.location(spark, name).removeprefix("file:"))
    return [path for path in folder.glob("part-*") if path.stat().st_size]


def test_a_reload_records_its_rows(spark, purchases, good_csv):
    assert tables.recorded_rows(spark, purchases) is None
    assert not tables.verify_table(spark, purchases)
    tables.reload_csv(spark, good_csv, purchases)
    assert tables.recorded_rows(spark, purchases) == len(samples.GOOD_ROWS)
    assert tables.table_rows(spark, purchases).first().total_rows == len(samples.GOOD_ROWS)
    assert tables.verify_table(spark, purchases)


def test_counting_runs_no_scan(spark, purchases, good_csv):
    tables.reload_csv(spark, good_csv, purchases)
    plan = tables.table_rows(spark, purchases)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "FileScan" not in plan


def test_empty_and_cleared_tables(spark, purchases, tmp_path, good_csv):
    tables.reload_csv(spark, samples.write(tmp_path / "empty.csv"), purchases)
    assert tables.table_rows(spark, purchases).first().total_rows == 0
    tables.reload_csv(spark, good_csv, purchases)
    tables.clear_table(spark, purchases)
    assert tables.table_rows(spark, purchases).first().total_rows == 0


def test_blanks_that_an_insert_cuts_keep_the_checksum(spark, purchases, tmp_path):
    path = samples.write(tmp_path / "wide.csv", samples.line(country="France" + " " * 30))
    tables.reload_csv(spark, path, purchases)
    assert tables.verify_table(spark, purchases)


def test_appends_make_the_record_void(spark, purchases, good_csv):
    tables.reload_csv(spark, good_csv, purchases)
    tables.load_csv(spark, good_csv, purchases)
    assert tables.recorded_rows(spark, purchases) is None
    assert tables.table_rows(spark, purchases).first().total_rows == 2 * len(samples.GOOD_ROWS)


def test_a_deleted_file_is_noticed(spark, purchases, good_csv):
    rows = read_csv(spark, good_csv, tables.USER_PURCHASE)
    tables.reload_table(rows.repartition(4, "invoice_number"), purchases)
    _parts(spark, purchases)[0].unlink()
    with pytest.raises(OSError, match="changed or deleted"):
        tables.recorded_rows(spark, purchases)


def test_other_rows_in_a_file_of_equal_length_are_noticed(spark, tmp_path, table_name):
    tables.create_table(spark, table_name, f"{tmp_path}/t", "a STRING, b INT", "csv")
    rows = spark.createDataFrame([("one", 1), ("two", 2)], "a string, b int").coalesce(1)
    tables.reload_table(rows, table_name)
    (part,) = _parts(spark, table_name)
    part.write_text(part.read_text().replace("two", "ten"))
    part.with_name(f".{part.name}.crc").unlink()
    spark.catalog.refreshTable(table_name)
    assert tables.recorded_rows(spark, table_name) == 2
    with pytest.raises(OSError, match="holds other rows"):
        tables.verify_table(spark, table_name)
