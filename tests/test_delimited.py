from __future__ import annotations

import gzip
import tempfile
import uuid
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from goldpan.schemas import MOVIE_REVIEW, USER_PURCHASE
from goldpan.sources.delimited import (
    MONTH_FIRST_TIMESTAMPS,
    read_csv,
    write_csv,
)
from goldpan.sources import records
from goldpan.sources.records import read_quoted_records
from tests import samples
from tests.conftest import JOB_ERRORS, values


def good_file(folder: Path) -> str:
    path = folder / "up_good.csv"
    path.write_text(samples.GOOD_FILE)
    return str(path)


@pytest.mark.parametrize("layout", ["files", "records"])
def test_good_file_is_read_exactly(spark, tmp_path, layout):
    loaded = read_csv(spark, good_file(tmp_path), USER_PURCHASE, layout=layout)
    assert loaded.schema == USER_PURCHASE
    assert values(loaded) == sorted(samples.GOOD_ROWS, key=repr)


@pytest.mark.parametrize("layout", ["files", "lines", "records"])
def test_columns_bind_by_position(spark, tmp_path, layout):
    path = tmp_path / "up_header_other.csv"
    path.write_text("h,g,f,e,d,c,b,a\n" + samples.GOOD_LINE + "\n")
    loaded = read_csv(spark, str(path), USER_PURCHASE, layout=layout)
    assert values(loaded) == samples.GOOD_ROWS[:1]
    assert loaded.columns == USER_PURCHASE.names


@pytest.mark.parametrize("layout", ["files", "lines", "records"])
@pytest.mark.parametrize(
    "bad",
    [
        samples.line(invoice_date="yesterday"),
        samples.line(invoice_date="12/1/2010 8:26"),
        samples.line(unit_price="999999.999"),
        samples.line(quantity="six"),
        samples.line(quantity='""'),
        samples.line(quantity="3000000000"),
        samples.line(country="France,extra field"),
        '536365,"never closed,plain,6,2010-12-01 08:26:00,2.550,17850,France',
        "536365,85123A,short row",
    ],
)
def test_one_bad_value_fails_the_load(spark, tmp_path, layout, bad):
    path = samples.write(tmp_path / "bad.csv", samples.GOOD_LINE, bad)
    with pytest.raises(JOB_ERRORS):
        read_csv(spark, path, USER_PURCHASE, layout=layout).collect()


@pytest.mark.parametrize("layout", ["files", "lines", "records"])
def test_month_first_timestamps_on_request(spark, tmp_path, layout):
    path = samples.write(tmp_path / "us.csv", samples.line(invoice_date="12/1/2010 8:26"))
    loaded = read_csv(
        spark, path, USER_PURCHASE, layout=layout, timestamp_format=MONTH_FIRST_TIMESTAMPS
    )
    assert loaded.first().invoice_date == datetime(2010, 12, 1, 8, 26)


@pytest.mark.parametrize("layout", ["files", "lines", "records"])
def test_prices_round_half_up(spark, tmp_path, layout):
    lines = [samples.line(unit_price=price) for price in ("2.5504", "2.5505")]
    path = samples.write(tmp_path / "up_round.csv", *lines)
    loaded = read_csv(spark, path, USER_PURCHASE, layout=layout).select("unit_price")
    assert values(loaded) == [(Decimal("2.550"),), (Decimal("2.551"),)]


def test_missing_path_is_named(spark, tmp_path):
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "absent.csv"), USER_PURCHASE)


def test_unknown_layout_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        read_csv(spark, good_file(tmp_path), USER_PURCHASE, layout="columns")


def test_header_only_file_is_empty(spark, tmp_path):
    for layout in ("files", "lines", "records"):
        path = samples.write(tmp_path / "up_empty.csv")
        assert read_csv(spark, path, USER_PURCHASE, layout=layout).isEmpty()


def test_export_has_a_header_and_quotes_only_where_needed(spark, tmp_path):
    target = str(tmp_path / "export")
    rows = spark.createDataFrame(samples.GOOD_ROWS, USER_PURCHASE)
    write_csv(rows.coalesce(1), target)
    (part,) = Path(target).glob("part-*")
    text = part.read_text()
    assert text.startswith(samples.HEADER + "\n")
    assert "536365,85123A,plain,6,2010-12-01 08:26:00.000000,2.550,17850,United Kingdom" in text
    assert '"say ""hi"", then\nleave"' in text
    assert values(read_csv(spark, target, USER_PURCHASE)) == sorted(samples.GOOD_ROWS, key=repr)


def test_exports_are_cut_into_files(spark, tmp_path):
    target = str(tmp_path / "export")
    rows = spark.createDataFrame(samples.GOOD_ROWS * 5, USER_PURCHASE).coalesce(1)
    write_csv(rows, target, rows_per_file=4)
    assert len(list(Path(target).glob("part-*"))) == 5
    assert values(read_csv(spark, target, USER_PURCHASE)) == values(rows)


def test_failed_export_keeps_the_earlier_one(spark, tmp_path):
    target = str(tmp_path / "export")
    write_csv(spark.createDataFrame(samples.GOOD_ROWS, USER_PURCHASE), target)
    bad = samples.write(tmp_path / "bad.csv", samples.line(quantity="six"))
    with pytest.raises(JOB_ERRORS):
        write_csv(read_csv(spark, bad, USER_PURCHASE), target)
    assert values(read_csv(spark, target, USER_PURCHASE)) == sorted(samples.GOOD_ROWS, key=repr)
    assert [path.name for path in tmp_path.iterdir() if path.is_dir()] == ["export"]


def test_compressed_files_are_read_in_one_piece(spark, tmp_path, setting):
    path = tmp_path / "up.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write(samples.GOOD_FILE)
    setting("spark.sql.files.maxPartitionBytes", "20b")
    setting("spark.sql.files.openCostInBytes", "1")
    loaded = read_csv(spark, str(path), USER_PURCHASE)
    assert values(loaded) == sorted(samples.GOOD_ROWS, key=repr)


texts = st.text(
    # a database text holds any character but NUL
    st.characters(codec="utf-8", exclude_characters="\u0000", exclude_categories=["Cs"]),
    max_size=12,
) | st.sampled_from(
    ["\r", "a\r\nb", "\u0001", '"', '""', ",", "\n", "\\", "\\N", " x ", '"\n"', "a\nb", '\n"', '\\"']
)
purchases = st.tuples(
    st.none() | texts,
    st.none() | texts,
    st.none() | texts,
    st.none() | st.integers(-(2**31), 2**31 - 1),
    st.none() | st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)),
    st.none() | st.integers(-99999999, 99999999).map(lambda n: Decimal(n).scaleb(-3)),
    st.integers(-(2**31), 2**31 - 1),
    st.none() | texts,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(purchases, min_size=1, max_size=30), st.integers(11, 90))
def test_any_rows_survive_export_and_load(spark, setting, rows, split_bytes):
    with tempfile.TemporaryDirectory() as folder:
        target = f"{folder}/export"
        write_csv(spark.createDataFrame(rows, USER_PURCHASE), target)
        expected = sorted(rows, key=repr)
        assert values(read_csv(spark, target, USER_PURCHASE, layout="files")) == expected
        # splits of a few bytes: records cross one or many of them
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{split_bytes}b")
        try:
            assert values(read_csv(spark, target, USER_PURCHASE, layout="records")) == expected
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


@pytest.mark.parametrize(
    "content",
    [
        b'id,text\n' + b'7,7" nail\n' * 30,
        b'id,text\n1,a"b"\n2,"x""\ny"\n3,""\n4,"""",\n'.replace(b",\n", b"\n"),
        b'\n\nid,text\n\n1,"a\n\nb"\n\n2,0" x\n',
        b'id,text\n1,"a,""\n"",b"\n2, "c\n3,d "\n',
    ],
)
@pytest.mark.parametrize("split", ["5b", "12b", "10000b"])
def test_records_follow_the_reader(spark, tmp_path, setting, content, split):
    path = tmp_path / "raw.csv"
    path.write_bytes(content)
    expected = values(read_csv(spark, str(path), MOVIE_REVIEW, layout="files"))
    setting("spark.sql.files.maxPartitionBytes", split)
    assert values(read_csv(spark, str(path), MOVIE_REVIEW, layout="records")) == expected


def test_records_end_with_either_line_ending(spark, tmp_path, setting):
    path = tmp_path / "crlf.csv"
    path.write_bytes(b'id,text\r\n1,"a\r\nb"\r\n2,plain\r\n3,"last"')
    setting("spark.sql.files.maxPartitionBytes", "7b")
    loaded = read_csv(spark, str(path), MOVIE_REVIEW, layout="records")
    assert values(loaded) == [(1, "a\r\nb"), (2, "plain"), (3, "last")]


def test_lines_that_end_in_carriage_returns_alone(spark, tmp_path, setting):
    path = tmp_path / "cr.csv"
    path.write_bytes(b"id,text\r1,a\r2,b\r")
    for layout in ("files", "lines"):
        assert values(read_csv(spark, str(path), MOVIE_REVIEW, layout=layout)) == [
            (1, "a"),
            (2, "b"),
        ]
    for header in (True, False):
        with pytest.raises(JOB_ERRORS, match="carriage return"):
            read_csv(spark, str(path), MOVIE_REVIEW, header, layout="records").collect()


def test_a_carriage_return_in_a_field_is_a_line_break(spark, tmp_path, setting):
    path = tmp_path / "field.csv"
    path.write_bytes(b'id,text\n' + b'1,"a\rb"\n' * 20)
    setting("spark.sql.files.maxPartitionBytes", "50b")
    loaded = read_csv(spark, str(path), MOVIE_REVIEW)
    assert values(loaded) == [(1, "a\rb")] * 20


def test_each_file_of_a_folder_has_its_own_header_and_records(spark, tmp_path, setting):
    folder = tmp_path / "many"
    folder.mkdir()
    for number in range(3):
        (folder / f"{number}.csv").write_text(f'id,text\n{number},"x\ny"\n{number}0,z\n')
    setting("spark.sql.files.maxPartitionBytes", "9b")
    loaded = read_csv(spark, str(folder), MOVIE_REVIEW, layout="records")
    assert values(loaded) == sorted(
        [(n, "x\ny") for n in range(3)] + [(n * 10, "z") for n in range(3)], key=repr
    )
    without_header = read_quoted_records(spark, str(folder), header=False)
    assert without_header.count() == 9


def test_one_large_file_is_read_in_as_many_tasks_as_splits(spark, tmp_path, setting):
    """The default, with and without line breaks in fields, and with a few splits of them."""
    broken = ["1,plain"] * 3000 + ['2,"a\nb"'] + ["3,plain"] * 3000
    for name, lines in (("plain", ["1,plain"] * 6000), ("broken", broken)):
        path = tmp_path / f"{name}.csv"
        path.write_text("id,text\n" + "\n".join(lines) + "\n")
        setting("spark.sql.files.maxPartitionBytes", "4kb")
        setting("spark.sql.files.openCostInBytes", "1")
        splits = -(-path.stat().st_size // 4096)
        loaded = read_csv(spark, str(path), MOVIE_REVIEW)
        assert loaded.rdd.getNumPartitions() >= splits > 10
        expected = values(read_csv(spark, str(path), MOVIE_REVIEW, layout="files"))
        assert values(loaded) == expected
        plan = loaded._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_a_header_across_splits_and_after_empty_lines(spark, tmp_path, setting):
    path = tmp_path / "head.csv"
    path.write_text('\n' * 40 + '"i\nd","te\n\nxt"\n1,"a\nb"\n2,c\n')
    for split in ("3b", "16b", "1kb"):
        setting("spark.sql.files.maxPartitionBytes", split)
        assert values(read_csv(spark, str(path), MOVIE_REVIEW)) == [(1, "a\nb"), (2, "c")]


def test_a_field_that_is_never_closed_is_named(spark, tmp_path, setting):
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "good.csv").write_text('id,text\n1,"x"\n')
    (folder / "bad.csv").write_text('id,text\n1,"ok"\n2,"never closed\n' + "3,more\n" * 50)
    setting("spark.sql.files.maxPartitionBytes", "20b")
    with pytest.raises(JOB_ERRORS, match=r"never closed in .*bad\.csv; .* after byte 0"):
        read_csv(spark, str(folder), MOVIE_REVIEW)


def test_changed_splits_are_noticed(spark, tmp_path, setting):
    path = tmp_path / "changed.csv"
    path.write_text("id,text\n" + '1,"a\nb"\n' * 40)
    setting("spark.sql.files.maxPartitionBytes", "50b")
    loaded = read_csv(spark, str(path), MOVIE_REVIEW)
    setting("spark.sql.files.maxPartitionBytes", "33b")
    with pytest.raises(JOB_ERRORS, match="read the files again"):
        loaded.collect()


def test_a_record_longer_than_many_splits(spark, tmp_path, setting):
    text = "\n".join(uuid.uuid4().hex for _ in range(200))
    path = tmp_path / "long.csv"
    path.write_text(f'id,text\n1,"{text}"\n2,end\n')
    setting("spark.sql.files.maxPartitionBytes", "64b")
    loaded = read_csv(spark, str(path), MOVIE_REVIEW, layout="records")
    assert values(loaded) == [(1, text), (2, "end")]


def test_files_without_line_breaks_are_scanned_without_python(spark, tmp_path, setting, monkeypatch):
    path = tmp_path / "plain.csv"
    path.write_text("id,text\n" + "\n".join(f'{n},"a, b"' for n in range(3000)) + "\n")
    setting("spark.sql.files.maxPartitionBytes", "4kb")
    with monkeypatch.context() as patch:
        patch.setattr(records, "_fold", None)
        found = records.scan(spark, str(path))
    assert found.lines_are_records
    # a single field with a line break, behind what is looked at first
    path.write_text(path.read_text() + '1,"a\nb"\n')
    found = records.scan(spark, str(path))
    assert not found.lines_are_records
    assert read_csv(spark, str(path), MOVIE_REVIEW).count() == 3001


def test_splits_that_records_cross_are_named_without_a_job(spark, tmp_path, setting, monkeypatch):
    path = tmp_path / "crossed.csv"
    path.write_text("id,text\n" + '1,"a\n\nb"\n' * 200)
    setting("spark.sql.files.maxPartitionBytes", "100b")
    found = records.scan(spark, str(path))
    monkeypatch.setattr(spark, "createDataFrame", None)
    rows = read_quoted_records(spark, str(path), found=found)
    assert values(rows) == [('1,"a\n\nb"',)] * 200


def test_records_of_a_batch_are_put_together_at_once():
    lines = ['x"', '1,"a', "", 'b"', "", "2,c", '3,"d', "e"]
    codes = np.array([0, 2, 4, 0, 4, 1, 2, 1])
    known = (np.array([v]) for v in (0, True, 0, True, False))
    splits = records.FileSplits(*known, [None], 9, np.array([0]))
    built = records._Records({7: splits}, header=False)
    built.begin((7, 0))
    whole = [array.to_pylist() for array in built.add(pa.array(lines), codes)]
    assert whole == [['1,"a\n\nb"', "2,c"]]
    assert list(built.end_split()) == []
    assert [piece[0] for piece in built.pieces] == ['x"', '3,"d\ne']


@pytest.mark.parametrize("most", [0, 2, 1000])
@pytest.mark.parametrize("split", ["9b", "40b", "100b"])
def test_ends_of_records_come_from_the_first_pass(spark, tmp_path, setting, monkeypatch, split, most):
    lines = [f'{n},"a{n}\n\n""b"",\nc"' if n % 3 else f"{n},plain" for n in range(60)]
    path = tmp_path / "crossed.csv"
    path.write_text('"i\nd",text\n' + "\n".join(lines) + "\n")
    expected = values(read_csv(spark, str(path), MOVIE_REVIEW, layout="files"))
    setting("spark.sql.files.maxPartitionBytes", split)
    monkeypatch.setattr(records, "_HEAD_LINES", most)
    loaded = read_csv(spark, str(path), MOVIE_REVIEW)
    assert values(loaded) == expected
    # long enough splits and heads need no third pass and no shuffle
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" not in plan) == (split != "9b" and most == 1000)


def test_compressed_exports(spark, tmp_path):
    rows = spark.createDataFrame(samples.GOOD_ROWS * 100, USER_PURCHASE).coalesce(1)
    sizes = {}
    for compression in (None, "gzip"):
        target = tmp_path / str(compression)
        write_csv(rows, str(target), rows_per_file=150, compression=compression)
        parts = list(target.glob("part-*"))
        assert len(parts) == 3
        assert {part.suffix for part in parts} == {".gz" if compression else ".csv"}
        for layout in ("records", "files"):
            assert values(read_csv(spark, str(target), USER_PURCHASE, layout=layout)) == values(rows)
        sizes[compression] = sum(part.stat().st_size for part in parts)
    with gzip.open(parts[0], "rt") as text:
        assert text.readline() == samples.HEADER + "\n"
    assert sizes["gzip"] * 4 < sizes[None]
