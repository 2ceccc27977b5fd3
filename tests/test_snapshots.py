from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pyspark.sql.classic.dataframe import DataFrame as Frame

from cardloom.functions.rules import strict_rules
from cardloom.operators.cleaning import clean, deduplicate
from cardloom.schema import transactions_schema
from cardloom.sources import snapshots
from cardloom.streaming.jobs import merge_transactions

SCHEMA = "id LONG, value STRING"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "table")

    def enter(rows, batch, source="s", combine=lambda both: both.groupBy("id").agg(F.max("value").alias("value"))):
        return snapshots.merge_batch(spark.createDataFrame(rows, SCHEMA), path, "id DIV 10", combine, source, batch)

    def read(back=0):
        versions = sorted(row.version for row in snapshots.read_log(spark, path).collect())
        return rows_of(snapshots.read_snapshot(spark, path, spark.createDataFrame([], SCHEMA).schema,
                                               versions[-1 - back] if versions else None))

    return path, enter, read


def test_only_touched_blocks_are_written(table, tmp_path):
    path, enter, read = table
    assert read() == []
    enter([(1, "a"), (12, "b")], 0)
    enter([(1, "c"), (2, "d")], 1)
    assert read() == [(1, "c"), (12, "b"), (2, "d")] and read(1) == [(1, "a"), (12, "b")]
    written = sorted(str(p.relative_to(tmp_path / "table" / "data")).split("/")[0] for p in (tmp_path / "table" / "data").glob("block*/*"))
    assert written == ["block=0", "block=0", "block=1"]


def test_a_batch_counts_once_by_source(table):
    path, enter, read = table
    assert enter([(1, "a")], 0) and not enter([(1, "z")], 0)
    assert enter([(3, "b")], 0, source="other") and enter([], 1)
    assert not enter([(4, "z")], 0)  # an earlier batch of a source that went on
    assert read() == [(1, "a"), (3, "b")]


def test_emptied_blocks_and_replacement(table, spark):
    path, enter, read = table
    enter([(1, "a"), (12, "b")], 0)
    enter([(2, "x")], 1, combine=lambda both: both.where("id > 10"))
    assert read() == [(12, "b")]
    enter([(3, "c")], 2)
    snapshots.replace_table(spark.createDataFrame([(50, "n")], SCHEMA), path, "id DIV 10")
    assert read() == [(50, "n")]
    assert enter([(51, "m")], 3) and read() == [(50, "n"), (51, "m")]


@pytest.mark.parametrize("place", ["rows", "blocks", "log"])
def test_a_write_that_fails_half_way_leaves_the_old_table(table, monkeypatch, place):
    path, enter, read = table
    enter([(1, "a"), (12, "b")], 0)
    if place == "rows":
        broken = lambda both: both.selectExpr("id", "IF(id = 2, raise_error('broken'), value) AS value")
        with pytest.raises(Exception, match="broken"):
            enter([(2, "c"), (13, "d")], 1, combine=broken)
    else:
        whole = Frame.coalesce

        def fail(frame, n):
            if ("standing" in frame.columns) == (place == "blocks"):
                raise RuntimeError("broken")
            return whole(frame, n)

        with monkeypatch.context() as patch:
            patch.setattr(Frame, "coalesce", fail)
            with pytest.raises(RuntimeError, match="broken"):
                enter([(2, "c"), (25, "left over")], 1)
    assert read() == [(1, "a"), (12, "b")]
    assert enter([(2, "c"), (13, "d")], 1)  # the same number, other rows: nothing left over comes in
    assert read() == [(1, "a"), (12, "b"), (13, "d"), (2, "c")]


def test_old_versions_are_dropped(table, spark, tmp_path):
    path, enter, read = table
    for batch in range(5):
        enter([(1, str(batch)), (10 * batch + 100, "x")], batch)
    before = read()
    assert snapshots.drop_old_versions(spark, path) == 3
    assert read() == before and read(1) != before
    assert snapshots.drop_old_versions(spark, path) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_equals_one_batch(spark, make_transactions, tmp_path, seed):
    rng = random.Random(seed)
    rows = [{"transaction_id": rng.randrange(40) or None, "tx_datetime": datetime(2024, 1, 1) + timedelta(days=rng.randrange(9)),
             "tx_amount": rng.choice([1.0, 2.0, -1.0]), "customer_id": rng.randrange(-1, 5)} for _ in range(150)]
    want = rows_of(clean(make_transactions(*rows), strict_rules()))
    cuts = sorted(rng.sample(range(1, 150), 3))
    path = str(tmp_path / "t")
    for number, (a, b) in enumerate(zip([0, *cuts], [*cuts, 150])):
        assert merge_transactions(make_transactions(*rows[a:b]), path, "feed", number, block_ids=16)
    assert rows_of(snapshots.read_snapshot(spark, path, transactions_schema(wide_ids=True))) == want
    assert not merge_transactions(make_transactions(*rows[:20]), path, "feed", 2, block_ids=16)
    assert rows_of(snapshots.read_snapshot(spark, path, transactions_schema(wide_ids=True))) == want
    assert len(want) == deduplicate(spark.createDataFrame(want, transactions_schema(wide_ids=True))).count()
