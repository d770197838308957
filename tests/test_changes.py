"""Change sets of reloads, gold that follows them, and arrivals in a typed table."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest

from goldpan.operators import tables
from goldpan.operators.changes import as_changes, changes
from goldpan.plans import gold, gold_state
from goldpan.schemas import CLASSIFIED_REVIEW, REVIEW_LOGS, USER_PURCHASE
from goldpan.streaming import arrivals
from tests import samples
from tests.conftest import JOB_ERRORS, values


def purchase(rng):
    price = rng.choice([None, Decimal("1.250"), Decimal("0.001"), Decimal("9.990")])
    return (
        rng.choice(["1", "2", None]), rng.choice(["a", None]), None, rng.choice([None, 1, -2, 7]),
        datetime(2020, 1, rng.randint(1, 3)), price, rng.choice([None, 1, 2, 3, 4, 5]), "x",
    )


def frame(spark, rows, schema=USER_PURCHASE):
    return spark.createDataFrame(rows, schema)


def counted(df):
    return {tuple(row)[:-1]: row.change for row in df.collect()}


def test_changes_equal_multiset_difference(spark):
    rng = random.Random(1)
    old = [purchase(rng) for _ in range(300)] + [("9", "hot", None, 1, None, None, 1, "y")] * 200
    new = [purchase(rng) for _ in range(280)] + [("9", "hot", None, 1, None, None, 1, "y")] * 203
    # nulls beside equal values change places
    old.append((None, "swap", None, None, None, None, None, "z"))
    new.append(("swap", None, None, None, None, None, None, "z"))
    expected = Counter(new)
    expected.subtract(Counter(old))
    found = counted(changes(frame(spark, old), frame(spark, new)))
    assert found == {row: n for row, n in expected.items() if n}
    assert counted(changes(frame(spark, old), frame(spark, old))) == {}
    assert sum(counted(changes(frame(spark, []), frame(spark, new))).values()) == len(new)


def test_rows_that_stay_are_not_shuffled_whole(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = frame(spark, [purchase(random.Random(2))] * 3)
    plan = changes(rows, rows)._jdf.queryExecution().executedPlan().toString()
    counted_first = [line for line in plan.splitlines() if "keys=[code" in line]
    assert counted_first and all("invoice" not in line for line in counted_first)


def test_reload_changes(spark, tmp_path, table_name):
    tables.create_table(spark, table_name, str(tmp_path / "table"))
    rng = random.Random(3)
    first, second = ([purchase(rng) for _ in range(50)] for _ in range(2))
    tables.reload_table(frame(spark, first), table_name)
    assert counted(tables.reload_changes(spark, table_name)) == dict(Counter(first))
    tables.reload_table(frame(spark, second), table_name)
    expected = Counter(second)
    expected.subtract(Counter(first))
    found = counted(tables.reload_changes(spark, table_name))
    assert found == {row: n for row, n in expected.items() if n}
    tables.drop_table(spark, table_name)


def test_gold_follows_changes(spark):
    """Two increments and one removal of all three sets, against full gold each time."""
    rng = random.Random(4)

    def silver(n):
        return (
            [purchase(rng) for _ in range(n)],
            [(rng.randint(1, 9), 3, rng.randint(0, 1)) for _ in range(n)],
            [(rng.randint(1, 9), rng.randint(1, 6), "d", 1.0) for _ in range(n)],
        )

    schemas = (USER_PURCHASE, CLASSIFIED_REVIEW, REVIEW_LOGS)
    now = [[], [], []]
    state = gold_state.purchase_deltas(as_changes(frame(spark, [])))
    for step in ("add", "add", "remove"):
        if step == "add":
            after = [old + more for old, more in zip(now, silver(25))]
        else:
            after = [[row for row in rows if rng.random() < 0.4] for rows in now]
            after[0] = [row for row in after[0] if row[6] not in (2, 3)]
        before = [frame(spark, rows, schema) for rows, schema in zip(now, schemas)]
        new = [frame(spark, rows, schema) for rows, schema in zip(after, schemas)]
        delta = [changes(b, n) for b, n in zip(before, new)]
        following = gold_state.apply_changes(
            state, *delta, classified_before=as_changes(before[1]), logs_after=as_changes(new[2])
        )
        state = spark.createDataFrame(following.collect(), state.schema)
        now = after
        expected = gold.movie_analytics(*new)
        assert values(gold_state.gold_of(state)) == values(expected)


@pytest.fixture
def folders(spark, tmp_path, table_name):
    (tmp_path / "landing").mkdir()
    tables.create_table(spark, table_name, str(tmp_path / "table"))
    yield {"landing": str(tmp_path / "landing"), "table": table_name, "checkpoint": str(tmp_path / "cp")}
    tables.drop_table(spark, table_name)


def test_arrivals_are_in_the_table_once(spark, folders, tmp_path, table_name):
    good = sorted(samples.GOOD_ROWS, key=repr)
    for name in ("a", "b"):
        (tmp_path / "landing" / f"{name}.csv").write_text(samples.GOOD_FILE)
        for _ in range(2):
            arrivals.load_arrivals(spark, **folders)
    assert values(spark.table(table_name)) == sorted(good * 2, key=repr)


@pytest.mark.parametrize("dies", ["before the write", "after the write", "after the ledger"])
def test_a_batch_that_dies_is_loaded_once(spark, folders, tmp_path, table_name, monkeypatch, dies):
    landing = tmp_path / "landing"
    (landing / "a.csv").write_text(samples.GOOD_FILE)
    arrivals.load_arrivals(spark, **folders)
    samples.write(landing / "b.csv", *[samples.GOOD_LINE] * 5)
    write, read = arrivals.write_new_text, arrivals.read_csv

    def ledger(session, path, text):
        if path.endswith("-done") and dies == "after the write":
            raise RuntimeError("killed")
        write(session, path, text)
        if path.endswith("-done") and dies == "after the ledger":
            raise RuntimeError("killed")

    def reader(*args, **options):
        if dies == "before the write":
            raise RuntimeError("killed")
        return read(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "write_new_text", ledger)
        patch.setattr(arrivals, "read_csv", reader)
        with pytest.raises(Exception, match="killed"):
            arrivals.load_arrivals(spark, **folders)
    spark.catalog.refreshTable(table_name)
    assert spark.table(table_name).count() == (4 if dies == "before the write" else 9)
    arrivals.load_arrivals(spark, **folders)
    spark.catalog.refreshTable(table_name)
    assert spark.table(table_name).count() == 9


def test_a_bad_arrival_leaves_the_table(spark, folders, tmp_path, table_name):
    landing = tmp_path / "landing"
    samples.write(landing / "a.csv", samples.line(country="x" * 21))
    with pytest.raises(JOB_ERRORS):
        arrivals.load_arrivals(spark, **folders)
    assert spark.table(table_name).isEmpty()
    samples.write(landing / "a.csv", samples.GOOD_LINE)
    arrivals.load_arrivals(spark, **folders)
    assert spark.table(table_name).count() == 1
