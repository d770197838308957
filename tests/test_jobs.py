from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

from goldpan.__main__ import main
from goldpan.operators.tables import drop_table
from goldpan.plans import jobs, workflows
from goldpan.schemas import USER_PURCHASE
from goldpan.sources.delimited import MONTH_FIRST_TIMESTAMPS, read_csv, write_csv
from goldpan.sources.formats import BUILT_IN_FORMATS, read_dataset
from tests import samples
from tests.conftest import JOB_ERRORS, values

LOG = "<log><userId>{}</userId><device>d</device><score>1.5</score></log>"
PURCHASES = [
    ("1", "a", "x", 2, datetime(2020, 1, 1), Decimal("1.500"), 1, "France"),
    ("2", "b", None, 1, datetime(2020, 1, 2), Decimal("0.250"), 2, None),
]
GOLD = [
    (1, Decimal("3.000"), 2, 1),
    (2, Decimal("0.250"), 0, 0),
]


@pytest.fixture
def bronze(spark, tmp_path):
    base = tmp_path / "bronze"
    write_csv(spark.createDataFrame(PURCHASES, USER_PURCHASE), f"{base}/user_purchase.csv")
    write_csv(
        spark.createDataFrame(
            [(1, "so\ngood"), (2, "bad, \"really\"")], "id_review long, review_str string"
        ),
        f"{base}/movie_review.csv",
    )
    write_csv(
        spark.createDataFrame(
            [(1, LOG.format(1)), (2, LOG.format(1))], "id_review long, log string"
        ),
        f"{base}/log_reviews.csv",
    )
    return [f"{base}/{name}.csv" for name in ("user_purchase", "movie_review", "log_reviews")]


def test_names(spark):
    assert set(jobs.JOBS) == {"test", "show", "rl", "crm", "cmr", "up", "ma"}
    with pytest.raises(ValueError, match="'xx'.*test, show, rl, crm"):
        jobs.run_job(spark, "xx")


def test_smoke(spark):
    assert jobs.run_job(spark, "test").first().total_rows == 1_000


@pytest.mark.parametrize("fmt", BUILT_IN_FORMATS)
def test_jobs_one_by_one(spark, bronze, tmp_path, fmt):
    base = f"{tmp_path}/run"
    purchases, reviews, logs = bronze
    up = jobs.run_job(spark, "up", purchases, f"{base}/silver/user_purchase", fmt)
    assert values(up) == values(spark.createDataFrame(PURCHASES, USER_PURCHASE))
    cmr = jobs.run_job(spark, "cmr", reviews, f"{base}/silver/classified_movie_review", fmt)
    assert values(cmr) == [(1, 1, 1), (2, 2, 0)]
    rl = jobs.run_job(spark, "rl", logs, f"{base}/silver/review_logs", fmt)
    assert values(rl) == [(1, 1, "d", 1.5), (2, 1, "d", 1.5)]
    assert values(jobs.run_job(spark, "ma", base, fmt)) == GOLD
    shown = jobs.run_job(
        spark, "show", f"{base}/silver/user_purchase", fmt, 1, USER_PURCHASE, ["invoice_number"]
    )
    assert shown.first().invoice_number == "1"


def test_bronze_to_gold(spark, bronze, tmp_path, table_name):
    base = f"{tmp_path}/run"
    for _ in range(2):
        assert values(workflows.bronze_to_gold(spark, *bronze, base, table_name)) == GOLD
    assert values(spark.table(table_name)) == PURCHASES
    exported = read_csv(spark, f"{base}/export/{table_name}_csv", USER_PURCHASE)
    assert values(exported) == PURCHASES
    assert values(read_dataset(spark, f"{base}/gold/movie_analytics")) == GOLD
    drop_table(spark, table_name)


@pytest.mark.parametrize("compression", ["by default", None])
def test_the_export_of_a_run_takes_little_space(spark, bronze, tmp_path, table_name, compression):
    options = {} if compression else {"export_compression": None}
    many = spark.createDataFrame(PURCHASES * 500, USER_PURCHASE).coalesce(1)
    write_csv(many, bronze[0])
    workflows.bronze_to_gold(spark, *bronze, f"{tmp_path}/run", table_name, **options)
    exported = tmp_path / "run" / "export" / f"{table_name}_csv"
    written = sum(part.stat().st_size for part in exported.glob("part-*"))
    assert (written < 1000 * 10) == bool(compression)  # a row has 40 characters
    assert values(read_csv(spark, str(exported), USER_PURCHASE)) == values(many)
    drop_table(spark, table_name)


def test_jobs_alone(spark, bronze, tmp_path):
    assert values(workflows.run_jobs(spark, *bronze, f"{tmp_path}/run", "json")) == GOLD


def test_load_and_export(spark, bronze, tmp_path, table_name):
    target = f"{tmp_path}/export"
    for _ in range(2):
        loaded = workflows.load_purchases(spark, bronze[0], table_name, f"{tmp_path}/table")
        assert loaded.first().total_rows == 2
    assert workflows.export_purchases(spark, table_name, target)
    assert values(read_csv(spark, target, USER_PURCHASE)) == PURCHASES


def test_month_first_files_run_through(spark, bronze, tmp_path, table_name):
    path = samples.write(tmp_path / "us.csv", samples.line(invoice_date="12/1/2010 8:26"))
    workflows.bronze_to_gold(
        spark, path, *bronze[1:], f"{tmp_path}/run", table_name,
        timestamp_format=MONTH_FIRST_TIMESTAMPS,
    )
    silver = read_dataset(spark, f"{tmp_path}/run/silver/user_purchase")
    assert silver.first().invoice_date == datetime(2010, 12, 1, 8, 26)


def test_a_failing_step_is_raised_and_gold_is_not_written(spark, bronze, tmp_path, table_name):
    purchases, reviews, _ = bronze
    bad = tmp_path / "logs.csv"
    bad.write_text("id_review,log\nnot a number,x\n")
    with pytest.raises(JOB_ERRORS):
        workflows.bronze_to_gold(spark, purchases, reviews, str(bad), f"{tmp_path}/run", table_name)
    assert not Path(f"{tmp_path}/run/gold").exists()


def test_an_empty_load_stops_the_run(spark, bronze, tmp_path, table_name):
    empty = samples.write(tmp_path / "empty.csv")
    with pytest.raises(ValueError, match="empty"):
        workflows.bronze_to_gold(spark, empty, *bronze[1:], f"{tmp_path}/run", table_name)
    assert not Path(f"{tmp_path}/run/silver").exists()


def test_command_line(spark, bronze, tmp_path, table_name, capsys):
    def run(*arguments):
        main(list(arguments))
        return capsys.readouterr().out

    silver = f"{tmp_path}/silver/user_purchase"
    assert "France" in run("up", bronze[0], silver, "orc")
    assert "invoice_number" in run("show", silver, "orc", "1")
    assert "|2" in run("load", bronze[0], table_name, f"{tmp_path}/table")
    assert run("export", table_name, f"{tmp_path}/export") == "True\n"
    assert "review_score" in run("jobs", *bronze, f"{tmp_path}/run")
    assert "review_score" in run("all", *bronze, f"{tmp_path}/all", f"{table_name}_2")
    for name in (table_name, f"{table_name}_2"):
        assert run("drop", name) == ""
        assert not spark.catalog.tableExists(name)
    for arguments in ([], ["no such job"]):
        with pytest.raises(SystemExit, match="usage"):
            main(arguments)
