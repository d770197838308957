from __future__ import annotations

import pytest

from goldpan import session


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (session.scratch_dir(spark, "x") for _ in range(2))
    application = spark.sparkContext.applicationId
    assert first.startswith(f"{shared}/goldpan/{application}/x-") and first != second


class FakeConf:
    @staticmethod
    def get(key, default):
        return default


class FakeContext:
    applicationId = "app"

    def __init__(self, master):
        self.master = master


class FakeSession:
    conf = FakeConf

    def __init__(self, master):
        self.sparkContext = FakeContext(master)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(FakeSession("yarn"), "x")


def test_a_local_session_may_use_its_own_disk():
    assert "/goldpan/app/x-" in session.scratch_dir(FakeSession("local[2]"), "x")


def test_session_sizes_its_shuffles(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        again = session.build_session(input_bytes=10 << 30)
        assert again.conf.get(key) == "80"
        assert again.conf.get("spark.sql.shuffle.partitions") == "80"
    finally:
        spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")


def test_partitions_stay_bounded():
    assert session.shuffle_partitions(1) == 8
    assert session.shuffle_partitions(128 << 30) == 1024
    sizes = [session.shuffle_partitions(1 << n) for n in range(30, 60)]
    assert sizes == sorted(sizes)
    assert session.shuffle_partitions(100 << 40) <= 20_000
