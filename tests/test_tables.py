from __future__ import annotations

import uuid
from pathlib import Path

import pytest

from goldpan.operators import tables
from goldpan.schemas import USER_PURCHASE
from goldpan.sources.delimited import read_csv
from tests import samples
from tests.conftest import JOB_ERRORS, shape, values


@pytest.fixture
def purchases(spark, tmp_path, table_name):
    tables.create_table(spark, table_name, f"{tmp_path}/tables/{table_name}")
    return table_name


@pytest.fixture
def good_csv(tmp_path):
    path = tmp_path / "up_good.csv"
    path.write_text(samples.GOOD_FILE)
    return str(path)


GOOD = sorted(samples.GOOD_ROWS, key=repr)


def test_created_table_is_typed_and_empty(spark, purchases):
    table = spark.table(purchases)
    assert shape(table.schema) == shape(USER_PURCHASE)
    assert table.isEmpty()
    ddl = spark.sql(f"SHOW CREATE TABLE {purchases}").first()[0]
    for column in ("invoice_number VARCHAR(10)", "detail VARCHAR(1000)", "country VARCHAR(20)"):
        assert column in ddl


def test_creating_again_keeps_the_rows(spark, purchases, good_csv, tmp_path):
    tables.load_csv(spark, good_csv, purchases)
    tables.create_table(spark, purchases, f"{tmp_path}/elsewhere")
    assert values(spark.table(purchases)) == GOOD


def test_loading_appends(spark, purchases, good_csv):
    tables.load_csv(spark, good_csv, purchases)
    tables.load_csv(spark, good_csv, purchases)
    assert tables.total_rows(spark.table(purchases)).first().total_rows == 2 * len(GOOD)


def test_reloading_is_idempotent(spark, purchases, good_csv):
    for _ in range(3):
        tables.reload_csv(spark, good_csv, purchases)
        assert values(spark.table(purchases)) == GOOD


def test_reload_after_append_replaces(spark, purchases, good_csv):
    tables.reload_csv(spark, good_csv, purchases)
    tables.load_csv(spark, good_csv, purchases)
    tables.reload_csv(spark, good_csv, purchases)
    tables.load_csv(spark, good_csv, purchases)
    assert spark.table(purchases).count() == 2 * len(GOOD)


@pytest.mark.parametrize(
    "bad",
    [
        samples.line(invoice_date="yesterday"),
        samples.line(unit_price="999999.999"),
        samples.line(invoice_number="12345678901"),
        samples.line(country="x" * 21),
        "short,row",
    ],
)
def test_failed_reload_keeps_the_old_rows(spark, purchases, good_csv, tmp_path, bad):
    tables.reload_csv(spark, good_csv, purchases)
    path = samples.write(tmp_path / "bad.csv", samples.GOOD_LINE, bad)
    versions = _versions(tmp_path, purchases)
    with pytest.raises(JOB_ERRORS):
        tables.reload_csv(spark, path, purchases)
    assert values(spark.table(purchases)) == GOOD
    assert _versions(tmp_path, purchases) == versions
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("goldpan_staged")]


def test_over_long_text_is_refused_and_blanks_are_cut(spark, purchases, tmp_path):
    path = samples.write(tmp_path / "up_long.csv", samples.line(invoice_number="12345678901"))
    with pytest.raises(JOB_ERRORS, match="EXCEED_LIMIT_LENGTH"):
        tables.load_csv(spark, path, purchases)
    path = samples.write(tmp_path / "blanks.csv", samples.line(invoice_number="1234567890   "))
    tables.load_csv(spark, path, purchases)
    assert spark.table(purchases).first().invoice_number == "1234567890"


def test_a_table_can_be_reloaded_from_itself(spark, purchases, good_csv):
    tables.reload_csv(spark, good_csv, purchases)
    tables.reload_table(spark.table(purchases).filter("customer_id = 17850"), purchases)
    assert spark.table(purchases).count() == 2


def test_a_reader_that_started_before_a_reload_is_not_disturbed(spark, purchases, good_csv):
    tables.reload_csv(spark, good_csv, purchases)
    reader = spark.table(purchases).select("invoice_number")
    before = values(reader)
    tables.clear_table(spark, purchases)
    assert values(reader) == before
    assert spark.table(purchases).isEmpty()


def test_clear_then_load(spark, purchases, good_csv):
    tables.load_csv(spark, good_csv, purchases)
    tables.clear_table(spark, purchases)
    assert tables.total_rows(spark.table(purchases)).first().total_rows == 0
    tables.load_csv(spark, good_csv, purchases)
    assert values(spark.table(purchases)) == GOOD


def test_drop_removes_rows_and_may_be_repeated(spark, purchases, good_csv, tmp_path):
    root = f"{tmp_path}/tables/{purchases}"
    tables.load_csv(spark, good_csv, purchases)
    tables.drop_table(spark, purchases)
    tables.drop_table(spark, purchases)
    assert not spark.catalog.tableExists(purchases)
    assert not _versions(tmp_path, purchases)
    tables.create_table(spark, purchases, root)
    assert spark.table(purchases).isEmpty()


def test_old_versions_can_be_removed(spark, purchases, good_csv, tmp_path):
    for _ in range(3):
        tables.reload_csv(spark, good_csv, purchases)
    tables.remove_old_versions(spark, purchases)
    assert len(_versions(tmp_path, purchases)) == 1
    assert values(spark.table(purchases)) == GOOD


def test_export_of_an_empty_table_leaves_the_earlier_export(
    spark, purchases, good_csv, tmp_path
):
    target = str(tmp_path / "export")
    assert not tables.export_if_nonempty(spark.table(purchases), target)
    assert not Path(target).exists()
    tables.load_csv(spark, good_csv, purchases)
    assert tables.export_if_nonempty(spark.table(purchases), target)
    tables.clear_table(spark, purchases)
    assert not tables.export_if_nonempty(spark.table(purchases), target)
    assert values(read_csv(spark, target, USER_PURCHASE)) == GOOD


def test_emptiness_check_does_not_count(spark):
    plan = spark.range(10)
    assert tables.is_nonempty(plan)
    assert not tables.is_nonempty(plan.filter("id > 10"))


def test_names_are_not_spliced_into_sql(spark):
    with pytest.raises(JOB_ERRORS):
        tables.drop_table(spark, "a; DROP TABLE b")
    with pytest.raises(ValueError, match="format"):
        tables.create_table(spark, "t", "/tmp/t", fmt="parquet LOCATION 'x'")


def test_other_tables_are_left_alone(spark, table_name):
    spark.sql(f"CREATE TABLE {table_name} (a INT) USING parquet")
    with pytest.raises(ValueError, match="create_table"):
        tables.clear_table(spark, table_name)


def _versions(tmp_path, name):
    return sorted(path.name for path in Path(f"{tmp_path}/tables/{name}").glob("*/version-*"))


def test_tables_under_one_root_are_safe_from_each_other(spark, good_csv, tmp_path):
    root = tmp_path / "shared"
    foreign = root / "foreign"
    foreign.mkdir(parents=True)
    (foreign / "kept.txt").write_text("x")
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    for name in names:
        tables.create_table(spark, name, str(root))
        tables.reload_csv(spark, good_csv, name)
    tables.remove_old_versions(spark, names[0])
    assert values(spark.table(names[1])) == GOOD
    tables.drop_table(spark, names[0])
    assert values(spark.table(names[1])) == GOOD
    assert (foreign / "kept.txt").exists()
    tables.drop_table(spark, names[1])
    assert [path.name for path in root.iterdir()] == ["foreign"]


def test_reloads_keep_a_bounded_number_of_versions(spark, purchases, good_csv, tmp_path):
    for _ in range(5):
        tables.reload_csv(spark, good_csv, purchases)
    assert len(_versions(tmp_path, purchases)) == 1 + tables.KEPT_VERSIONS
    assert values(spark.table(purchases)) == GOOD
