"""Every registered query against its SQL counterpart, on whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def reference_tables():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLES])
def test_query_equals_sql(spark, reference_tables, name):
    result = QUERIES[name](spark, SMALL)
    columns = sorted(result.columns)
    expected = reference_tables.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    expected = expected.project(", ".join(columns)).fetchall()
    rows = [tuple(row) for row in result.select(columns).collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_only_the_trained_classifier_has_no_sql():
    own = {name for name in QUERIES if not name.startswith("op") and name != "pipeline"}
    assert own - set(ORACLES) == {"classifier"}
    assert set(ORACLES) <= set(QUERIES)


def test_classifier_labels_every_review(spark):
    result = registered.classifier(spark, SMALL)
    assert result.columns == ["id_review", "positive_review"]
    assert result.count() == registered.silver_classified(spark, SMALL).count()


def test_flagship(spark):
    result = registered.entry(spark)
    assert result.columns == ["customer_id", "amount_spent", "review_count", "review_score"]
    assert not result.isEmpty()
