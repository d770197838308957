from __future__ import annotations

import pytest

from goldpan.schemas import USER_PURCHASE
from goldpan.sources.formats import read_dataset
from goldpan.streaming.arrivals import ingest_arrivals
from tests import samples
from tests.conftest import JOB_ERRORS, values


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "landing").mkdir()
    return {name: str(tmp_path / name) for name in ("landing", "target", "checkpoint")}


def loaded(spark, folders):
    return spark.read.schema(USER_PURCHASE).parquet(folders["target"])


def test_every_file_is_loaded_once(spark, folders, tmp_path):
    (tmp_path / "landing" / "a.csv").write_text(samples.GOOD_FILE)
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE)
    good = sorted(samples.GOOD_ROWS, key=repr)
    assert values(loaded(spark, folders)) == good
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE)
    assert values(loaded(spark, folders)) == good
    (tmp_path / "landing" / "deeper").mkdir()
    for name in ("b", "deeper/c"):
        (tmp_path / "landing" / f"{name}.csv").write_text(samples.GOOD_FILE)
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE, files_per_batch=1)
    assert values(loaded(spark, folders)) == sorted(good * 3, key=repr)


def test_a_json_sink_takes_little_space(spark, folders, tmp_path):
    samples.write(tmp_path / "landing" / "a.csv", *[samples.GOOD_LINE] * 2000)
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE, fmt="json")
    written = sum(part.stat().st_size for part in (tmp_path / "target").glob("part-*"))
    assert written < 2000 * 20  # the names alone are more than 80 bytes a row
    assert read_dataset(spark, folders["target"], "json", USER_PURCHASE).count() == 2000


def test_hidden_staging_folders_are_not_read(spark, folders, tmp_path):
    staging = tmp_path / "landing" / ".staging-1-a"
    staging.mkdir()
    samples.write(staging / "part.csv", samples.GOOD_LINE)
    samples.write(tmp_path / "landing" / "a.csv", samples.GOOD_LINE)
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE)
    assert loaded(spark, folders).count() == 1


def test_a_bad_file_stops_the_ingest_and_is_retried(spark, folders, tmp_path):
    samples.write(tmp_path / "landing" / "a.csv", samples.GOOD_LINE)
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE)
    bad = tmp_path / "landing" / "b.csv"
    samples.write(bad, samples.GOOD_LINE, samples.line(quantity="six"))
    with pytest.raises(JOB_ERRORS):
        ingest_arrivals(spark, **folders, schema=USER_PURCHASE)
    assert loaded(spark, folders).count() == 1
    samples.write(bad, samples.GOOD_LINE, samples.line(quantity="6"))
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE)
    assert loaded(spark, folders).count() == 3


def test_plain_lines_on_request(spark, folders, tmp_path):
    samples.write(tmp_path / "landing" / "a.csv", *[samples.GOOD_LINE] * 3)
    ingest_arrivals(spark, **folders, schema=USER_PURCHASE, line_breaks=False)
    assert loaded(spark, folders).count() == 3
