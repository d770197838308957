"""Versions of folders: every step of a publication may fail."""

from __future__ import annotations

from pathlib import Path

import pytest

from goldpan.sources import storage
from goldpan.sources.delimited import read_csv, write_csv
from goldpan.sources.formats import read_dataset, write_dataset
from goldpan.schemas import USER_PURCHASE
from tests import samples
from tests.conftest import values


@pytest.fixture
def two(spark):
    old = spark.createDataFrame([(i, "old") for i in range(20)], "a long, b string").repartition(3)
    new = spark.createDataFrame([(i, "new") for i in range(30)], "a long, b string").repartition(2)
    return old, new


def names(path):
    return {row.b for row in path.select("b").distinct().collect()}


@pytest.mark.parametrize("step", ["write_new_text", "_delete", "current manifest cut short"])
def test_a_failed_step_leaves_one_whole_version(spark, tmp_path, monkeypatch, two, step):
    old, new = two
    target = str(tmp_path / "data")
    write_dataset(old, target)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if step == "current manifest cut short":
            write = storage.write_new_text
            patch.setattr(storage, "write_new_text", lambda s, p, t: (write(s, p, t[:-4]), fail()))
        else:
            patch.setattr(storage, step, fail)
        with pytest.raises(OSError, match="lost"):
            write_dataset(new, target)
    after = read_dataset(spark, target)
    expected = new if step == "_delete" else old
    assert values(after) == values(expected)
    # files of both versions lie there, and the next write clears what is not its own
    assert len(list(Path(target).glob("part-*"))) == 5
    write_dataset(read_dataset(spark, target), target)
    assert values(read_dataset(spark, target)) == values(expected)
    assert values(spark.read.parquet(target)) == values(expected)
    assert len(list(Path(target).glob("_goldpan-manifest-*"))) == 1


def test_a_write_that_dies_half_way_is_not_seen(spark, tmp_path, two):
    """A dead driver leaves part files without a manifest."""
    old, new = two
    target = str(tmp_path / "data")
    write_dataset(old, target)
    new.write.mode("append").parquet(target)
    assert values(read_dataset(spark, target)) == values(old)
    write_dataset(new, target, "orc")
    assert values(read_dataset(spark, target, "orc")) == values(new)
    assert {p.suffix for p in Path(target).glob("part-*")} == {".orc"}


def test_exports_are_versions_as_well(spark, tmp_path):
    target = str(tmp_path / "export")
    rows = spark.createDataFrame(samples.GOOD_ROWS, USER_PURCHASE)
    write_csv(rows, target)
    rows.write.mode("append").option("header", True).csv(target)
    for layout in ("records", "files"):
        assert values(read_csv(spark, target, USER_PURCHASE, layout=layout)) == values(rows)


def test_a_missing_part_is_noticed(spark, tmp_path, two):
    target = tmp_path / "data"
    write_dataset(two[0], str(target))
    min(target.glob("part-*")).unlink()
    with pytest.raises(OSError, match="lacks 1 of 3 files"):
        read_dataset(spark, str(target))


def test_folders_without_a_manifest_are_read_whole(spark, tmp_path, two):
    target = str(tmp_path / "plain")
    two[0].write.parquet(target)
    two[1].write.mode("append").parquet(target)
    assert names(read_dataset(spark, target)) == {"old", "new"}
    assert names(read_dataset(spark, target + "*")) == {"old", "new"}
    write_dataset(two[1], target)
    assert names(read_dataset(spark, target)) == {"new"}
    assert storage.current_version(spark, str(tmp_path / "absent")) is None


def test_rows_are_added_to_a_version(spark, tmp_path, monkeypatch, two):
    old, new = two
    target = tmp_path / "export"
    write_csv(old, str(target))
    kept = {part.name: part.stat().st_mtime_ns for part in target.glob("part-*.csv")}
    old.write.mode("append").csv(str(target))  # of a write that died
    read = lambda: values(read_csv(spark, str(target), old.schema))
    with monkeypatch.context() as patch:
        patch.setattr(storage, "write_new_text", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write_csv(new, str(target), add=True)
    assert read() == values(old)
    for times in (1, 2):
        write_csv(new, str(target), add=True)
        assert read() == sorted(values(old) + times * values(new), key=repr)
    now = {part.name: part.stat().st_mtime_ns for part in target.glob("part-*.csv")}
    assert kept.items() < now.items() and len(now) == 3 + 2 * 2
    write_csv(new, str(target))
    assert read() == values(new)


def test_rows_are_added_where_no_version_is(spark, tmp_path, two):
    old, new = two
    target = str(tmp_path / "export")
    old.write.option("header", True).csv(target)
    write_csv(new, target, add=True)
    assert values(read_csv(spark, target, old.schema)) == values(old.unionAll(new))
    absent = str(tmp_path / "absent")
    write_csv(new, absent, add=True)
    assert values(read_csv(spark, absent, new.schema)) == values(new)
