from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from cardloom.functions.hashing import bucket_of, poisson_cdf, poisson_draw, unit_uniform
from cardloom.operators.sampling import (
    assign_split, class_counts, class_weights, oversample_minority, sample_rows, sample_with_replacement,
    split_rows,
)


def keys(spark, n=20000, partitions=4):
    return spark.range(0, n, 1, partitions).withColumnRenamed("id", "transaction_id")


def test_md5_uniform_matches_hashlib(spark):
    got = keys(spark, 50).selectExpr("transaction_id", f"{unit_uniform('s', 'transaction_id', method='md5')} AS u")
    for row in got.collect():
        digest = hashlib.md5(f"s:{row.transaction_id}".encode()).hexdigest()
        assert row.u == int(digest[:8], 16) / 2**32


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_uniform_is_uniform_and_salted(spark, method):
    a, b = (unit_uniform(s, "transaction_id", method=method) for s in "ab")
    stats = keys(spark).selectExpr(f"{a} AS a", f"{b} AS b").agg(
        F.expr("avg(a)"), F.expr("var_pop(a)"), F.expr("min(a)"), F.expr("max(a)"), F.expr("corr(a, b)")
    ).first()
    assert stats[0] == pytest.approx(0.5, abs=0.01)
    assert stats[1] == pytest.approx(1 / 12, abs=0.005)
    assert 0 <= stats[2] and stats[3] < 1
    assert abs(stats[4]) < 0.03


def test_buckets_are_even(spark):
    counts = keys(spark).groupBy(F.expr(bucket_of(10, "s", "transaction_id")).alias("b")).count().collect()
    assert sorted(r.b for r in counts) == list(range(10))
    assert all(abs(r["count"] - 2000) < 250 for r in counts)


def test_null_keys_are_drawn_like_any_other(spark):
    rows = spark.sql("SELECT CAST(NULL AS BIGINT) AS transaction_id")
    for method in ("md5", "xxhash64"):
        parts = split_rows(rows, (0.5, 0.5), method=method)
        assert sum(p.count() for p in parts) == 1


def test_unknown_method_is_refused():
    with pytest.raises(ValueError):
        unit_uniform("s", "k", method="crc")


@pytest.mark.parametrize("mean", [0.5, 1.0, 4.0])
def test_poisson_draw(spark, mean):
    table = poisson_cdf(mean)
    assert table[0] == pytest.approx(math.exp(-mean)) and table[-1] == pytest.approx(1)
    drawn = keys(spark).selectExpr(f"{unit_uniform('p', 'transaction_id')} AS u").selectExpr(
        f"{poisson_draw('u', mean)} AS k"
    )
    got = drawn.agg(F.expr("avg(k)"), F.expr("var_pop(k)")).first()
    assert got[0] == pytest.approx(mean, rel=0.05)
    assert got[1] == pytest.approx(mean, rel=0.07)


def test_poisson_table_of_a_large_mean_ends():
    table = poisson_cdf(5000.0)
    assert table[-1] == pytest.approx(1) and table[5000] == pytest.approx(0.5, abs=0.01) and len(table) < 6000


def test_split_is_a_partition_of_the_rows(spark):
    rows = keys(spark)
    parts = split_rows(rows, (0.8, 0.2))
    ids = [{r.transaction_id for r in p.collect()} for p in parts]
    assert not ids[0] & ids[1]
    assert len(ids[0] | ids[1]) == 20000
    assert len(ids[0]) == pytest.approx(16000, rel=0.03)
    named = {r.split: r["count"] for r in assign_split(rows, {"train": 8, "test": 2}).groupBy("split").count().collect()}
    assert named == {"train": len(ids[0]), "test": len(ids[1])}


def test_split_does_not_depend_on_partitioning(spark):
    one = {r.transaction_id for r in sample_rows(keys(spark, partitions=1), 0.1).collect()}
    many = {r.transaction_id for r in sample_rows(keys(spark).repartition(13), 0.1).collect()}
    assert one == many
    assert len(one) == pytest.approx(2000, rel=0.1)


def test_weights_are_scaled(spark):
    first = split_rows(keys(spark, 100000), (0.01, 0.95))[0].count()
    assert first == pytest.approx(100000 / 96, rel=0.12)


def test_sample_with_replacement(spark):
    taken = sample_with_replacement(keys(spark), 0.5)
    assert taken.columns == ["transaction_id"]
    assert taken.count() == pytest.approx(10000, rel=0.04)
    times = {r["count"] for r in taken.groupBy("transaction_id").count().select("count").distinct().collect()}
    assert {1, 2, 3} <= times


def labelled(spark, normal, fraud):
    return spark.range(normal + fraud).selectExpr("id AS transaction_id", f"CAST(id < {fraud} AS INT) AS tx_fraud")


@pytest.mark.parametrize("normal,fraud,factor", [(10, 3, 3), (9, 3, 3), (2, 5, 1), (7, 0, 1), (0, 4, 1), (0, 0, 1)])
def test_balance(spark, normal, fraud, factor):
    rows = labelled(spark, normal, fraud)
    counts = {r.tx_fraud: r.rows for r in class_counts(oversample_minority(rows)).collect()}
    assert counts == {k: v for k, v in {0: normal, 1: fraud * factor}.items() if v}
    weights = {(r.tx_fraud, r.class_weight) for r in class_weights(rows).collect()}
    assert weights == {w for w, n in (((0, 1.0), normal), ((1, float(factor)), fraud)) if n}


def test_copies_are_numbered_and_unknown_labels_left_out(spark):
    rows = labelled(spark, 4, 2).union(spark.sql("SELECT 99L, 2"))
    copies = oversample_minority(rows, copy_column="copy")
    fraud = sorted((r.transaction_id, r.copy) for r in copies.filter("tx_fraud = 1").collect())
    assert fraud == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert copies.filter("tx_fraud = 2").count() == 0
    assert oversample_minority(rows).columns == rows.columns


def test_balance_plan_has_no_join(spark):
    plan = oversample_minority(labelled(spark, 4, 2))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan and "Subquery" in plan
