from __future__ import annotations

import pytest

from goldpan.schemas import USER_PURCHASE
from goldpan.sources.delimited import read_csv
from goldpan.sources.formats import BUILT_IN_FORMATS, read_dataset, show_table, write_dataset
from tests import samples
from tests.conftest import JOB_ERRORS, values

GOOD = sorted(samples.GOOD_ROWS, key=repr)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(samples.GOOD_ROWS, USER_PURCHASE)


@pytest.mark.parametrize("fmt", BUILT_IN_FORMATS)
def test_every_format_keeps_every_value(spark, rows, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_dataset(rows, path, fmt)
    copy = read_dataset(spark, path, fmt, USER_PURCHASE)
    assert copy.schema == USER_PURCHASE
    assert values(copy) == GOOD


@pytest.mark.parametrize("fmt", BUILT_IN_FORMATS)
def test_writing_replaces(spark, rows, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_dataset(rows, path, fmt)
    write_dataset(rows.filter("quantity > 0"), path, fmt)
    assert read_dataset(spark, path, fmt, USER_PURCHASE).count() == 2


@pytest.mark.parametrize("fmt", ["json", "xml"])
def test_repeated_names_take_little_space(spark, rows, tmp_path, fmt):
    path = tmp_path / fmt
    many = rows.crossJoin(spark.range(500)).drop("id").coalesce(1)
    write_dataset(many, str(path), fmt)
    written = sum(part.stat().st_size for part in path.glob("part-*"))
    assert written < 2000 * 20  # the names alone are more than 100 bytes a row
    assert values(read_dataset(spark, str(path), fmt, USER_PURCHASE)) == sorted(GOOD * 500, key=repr)


def test_failed_write_keeps_the_earlier_dataset(spark, rows, tmp_path):
    path = str(tmp_path / "data")
    write_dataset(rows, path)
    bad = samples.write(tmp_path / "bad.csv", samples.line(quantity="six"))
    with pytest.raises(JOB_ERRORS):
        write_dataset(read_csv(spark, bad, USER_PURCHASE), path)
    assert values(read_dataset(spark, path)) == GOOD
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bad.csv", "data"]


def test_a_dataset_can_be_rewritten_from_itself(spark, rows, tmp_path):
    path = str(tmp_path / "data")
    write_dataset(rows, path)
    write_dataset(read_dataset(spark, path).filter("quantity > 0"), path)
    assert read_dataset(spark, path).count() == 2


def test_avro_is_accepted_and_names_its_module(spark, rows, tmp_path):
    try:
        write_dataset(rows, str(tmp_path / "avro"), "avro")
    except ValueError as error:
        assert "org.apache.spark:spark-avro_2.13" in str(error)
        with pytest.raises(ValueError, match="spark-avro"):
            read_dataset(spark, str(tmp_path), "avro")
    else:
        assert values(read_dataset(spark, str(tmp_path / "avro"), "avro")) == GOOD


def test_other_names_go_to_spark(spark, rows, tmp_path):
    with pytest.raises(JOB_ERRORS, match="DATA_SOURCE_NOT_FOUND"):
        write_dataset(rows, str(tmp_path / "x"), "papyrus")


def test_first_rows(spark, rows, tmp_path):
    path = str(tmp_path / "data")
    write_dataset(rows.repartition(4), path)
    assert show_table(spark, path, n=3).count() == 3
    assert show_table(spark, path, n="3").count() == 3
    assert show_table(spark, path, n=99).count() == len(GOOD)
    first = show_table(spark, path, n=2, order_by=["invoice_number"])
    assert [row.invoice_number for row in first.collect()] == ["536365", "536366"]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
