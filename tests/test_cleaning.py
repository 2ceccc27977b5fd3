from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cardloom.functions.rules import parity_rules, strict_rules
from cardloom.operators.cleaning import (
    apply_rules, count_reject_reasons, deduplicate, deduplicate_any, with_reject_reasons,
)
from cardloom.operators.profile import (
    SKETCH_BITS, daily_key_sketches, profile_key_count, profile_key_count_approx, relative_error, sketched_key_count,
    union_sketches,
)
from cardloom.sources.snapshots import read_snapshot
from cardloom.streaming.jobs import merge_key_sketches

DAY = datetime(2024, 1, 1)


def test_parity_keeps_nan_and_far_years_strict_does_not(make_transactions):
    rows = make_transactions(
        {"transaction_id": 1}, {"transaction_id": 2, "tx_amount": float("nan")},
        {"transaction_id": 3, "tx_datetime": datetime(2031, 1, 1)}, {"transaction_id": 4, "tx_datetime": None},
        {"transaction_id": 5, "terminal_id": 0}, {"transaction_id": 6, "tx_amount": None},
        {"transaction_id": None}, {"transaction_id": 8, "tx_time_days": -1},
    )

    def ids(rules):
        return {r.transaction_id for r in apply_rules(rows, rules).collect()}

    assert ids(parity_rules()) == {1, 2, 3, None, 8}
    assert ids(strict_rules(end_day="2025-01-01")) == {1}
    assert ids(strict_rules()) == {1, 3}


def test_year_limits(make_transactions):
    rows = make_transactions(
        {"transaction_id": 1, "tx_datetime": datetime(2017, 12, 31, 23, 59, 59)},
        {"transaction_id": 2, "tx_datetime": datetime(2018, 1, 1)},
        {"transaction_id": 3, "tx_datetime": datetime(2024, 12, 31, 23, 59, 59)},
        {"transaction_id": 4, "tx_datetime": datetime(2025, 1, 1)},
    )
    assert {r.transaction_id for r in apply_rules(rows, strict_rules(end_day="2025-01-01")).collect()} == {2, 3}


def test_every_rejected_row_has_a_reason(make_transactions):
    rows = make_transactions(
        {"transaction_id": 1}, {"transaction_id": 2, "customer_id": None, "tx_fraud": 5},
        {"transaction_id": 3, "tx_fraud_scenario": 9},
    )
    rejected = {r.transaction_id: r.reasons for r in with_reject_reasons(rows, strict_rules()).collect()}
    assert rejected == {2: ["customer_id", "tx_fraud"], 3: ["tx_fraud_scenario"]}
    counted = {r.reason: r.rows for r in count_reject_reasons(rows, strict_rules()).collect()}
    assert counted == {"customer_id": 1, "tx_fraud": 1, "tx_fraud_scenario": 1}
    assert apply_rules(rows, strict_rules()).count() + len(rejected) == 3


def test_dedup_keeps_the_earliest_and_breaks_ties(make_transactions):
    rows = make_transactions(
        {"transaction_id": 1, "tx_datetime": DAY + timedelta(days=1), "customer_id": 1},
        {"transaction_id": 1, "tx_datetime": DAY, "customer_id": 3},
        {"transaction_id": 1, "tx_datetime": DAY, "customer_id": 2, "tx_amount": 9.0},
        {"transaction_id": None, "customer_id": 8}, {"transaction_id": None, "customer_id": 7},
    )
    kept = {r.transaction_id: (r.customer_id, r.tx_amount) for r in deduplicate(rows).collect()}
    assert kept == {1: (2, 9.0), None: (7, 10.0)}
    assert deduplicate(rows).columns == rows.columns
    assert deduplicate_any(rows).count() == 2


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dedup_with_a_hot_key_is_the_same_for_any_partitioning(spark, partitions):
    # a third of the rows has one key
    rows = spark.range(3000).select(
        F.expr("if(id % 3 = 0, 7, id) AS transaction_id"),
        F.expr("timestamp_seconds(1704067200 + (id * 7919) % 1000) AS tx_datetime"),
        F.expr("id AS customer_id"),
    ).repartition(partitions)
    kept = deduplicate(rows)
    expected = {}
    for r in rows.collect():
        expected[r.transaction_id] = min(expected.get(r.transaction_id, (r.tx_datetime, r.customer_id)),
                                         (r.tx_datetime, r.customer_id))
    assert {r.transaction_id: (r.tx_datetime, r.customer_id) for r in kept.collect()} == expected


def test_dedup_combines_before_the_shuffle(spark):
    rows = spark.range(10).select(F.expr("id % 3 AS transaction_id"), F.expr("current_timestamp() AS tx_datetime"))
    plan = deduplicate(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")  # printed below the exchange


def test_key_counts(spark):
    rows = spark.range(1000).select(F.expr("if(id < 100, NULL, id % 300) AS transaction_id"))
    assert profile_key_count(rows).first()[0] == 301
    assert profile_key_count_approx(rows).first()[0] == pytest.approx(301, rel=0.06)
    assert profile_key_count(rows.filter("transaction_id > 5000")).first()[0] == 0


def test_strict_rules_reach_the_parquet_scan(spark, make_transactions, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    make_transactions({}).write.parquet(str(tmp_path / "t"))
    filtered = apply_rules(spark.read.parquet(str(tmp_path / "t")), strict_rules(end_day="2025-01-01")).select("transaction_id")
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("GreaterThanOrEqual(tx_datetime", "LessThan(tx_datetime", "GreaterThanOrEqual(customer_id,0)",
                 "GreaterThan(terminal_id,0)", "In(tx_fraud, [0,1])"):
        assert part in pushed


def test_sketches_of_days_add_up_to_the_sketch_of_all_rows(spark):
    rows = spark.range(30_000).selectExpr(
        "if(id % 500 = 0, NULL, id % 20000) AS transaction_id",
        "if(id % 7 = 0, NULL, TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id % 5 AS INT))) AS tx_datetime")
    daily = daily_key_sketches(rows)
    again = union_sketches(daily.union(daily))  # the same keys once more
    whole = union_sketches(rows.groupBy().agg(
        F.expr("count(*) AS rows"), F.expr("count_if(transaction_id IS NULL) AS null_keys"),
        F.expr(f"hll_sketch_agg(transaction_id, {SKETCH_BITS}) AS sketch")), [])
    exact = rows.where("transaction_id IS NOT NULL").select("transaction_id").distinct().count() + 1
    of_days, of_all = sketched_key_count(daily).first(), sketched_key_count(whole).first()
    assert of_days.rows == of_all.rows == 30_000
    assert of_days.distinct_keys == of_all.distinct_keys == sketched_key_count(again).first().distinct_keys
    assert of_days.distinct_keys == pytest.approx(exact, rel=relative_error())
    by_day = {r.day: r for r in sketched_key_count(daily, ["day"]).collect()}
    assert len(by_day) == 6 and sum(r.rows for r in by_day.values()) == 30_000
    assert tuple(sketched_key_count(daily.where("rows < 0")).first()) == (0, 0)
    only_null = rows.where("transaction_id IS NULL")
    assert sketched_key_count(daily_key_sketches(only_null)).first().distinct_keys == 1


def test_merged_sketches_do_not_change_when_a_batch_comes_again(spark, tmp_path):
    rows = spark.range(2_000).selectExpr("id AS transaction_id", "if(id < 10, NULL, TIMESTAMP '2024-01-01') AS tx_datetime")
    table, daily = str(tmp_path / "sketches"), daily_key_sketches(rows)
    for number in (0, 1, 1):
        merge_key_sketches(daily, table, "source", number)
    counted = sketched_key_count(read_snapshot(spark, table, daily.schema)).first()
    assert counted.rows == 4_000  # two batches with the same keys
    assert counted.distinct_keys == pytest.approx(2_000, rel=relative_error())
