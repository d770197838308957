from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# what a failing Spark job raises
JOB_ERRORS = (PySparkException, Py4JJavaError)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("goldpan-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # not UTC, so that a dependence on the session zone shows
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def table_name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def values(df):
    """Rows as an order-free, comparable list."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def shape(schema):
    """Names and types; tables and expressions differ in metadata and nullability."""
    return [(field.name, field.dataType.simpleString()) for field in schema]
