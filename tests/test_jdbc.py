"""Options only: a round trip needs a database, which the tests must not start."""

from __future__ import annotations

import pytest

from goldpan.sources import jdbc


def test_stride_places_the_cuts():
    options = jdbc.read_options(jdbc.Stride("customer_id", 1, 1000, 64))
    assert options["partitionColumn"] == "customer_id"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000")
    assert options["numPartitions"] == "64"
    assert options["preferTimestampNTZ"] == "true"


def test_a_read_says_how_it_is_split(spark):
    both = {"stride": jdbc.Stride("a", 0, 1, 2), "predicates": ["a = 1"]}
    for arguments in ({}, both):
        with pytest.raises(ValueError, match="either stride or predicates"):
            jdbc.read_table(spark, "jdbc:none:x", "t", **arguments)


def test_unknown_driver_is_reported(spark):
    for split in ({"stride": jdbc.Stride("a", 0, 1, 2)}, {"predicates": ["a = 1", "a <> 1"]}):
        with pytest.raises(Exception, match="(?i)suitable driver"):
            jdbc.read_table(spark, "jdbc:none:x", "t", **split)
    with pytest.raises(Exception, match="(?i)suitable driver"):
        jdbc.write_table(spark.range(1), "jdbc:none:x", "t")


def test_few_connections_leave_the_query_its_tasks(spark):
    rows = jdbc.dealt(spark.range(0, 1000, 1, 50).filter("id % 3 = 0"), 4)
    assert rows.rdd.getNumPartitions() == 4
    plan = rows._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning(4)" in plan and "Coalesce" not in plan
    assert rows.count() == 334
