from __future__ import annotations

import uuid

import pytest

from cardloom.functions.rules import strict_rules
from cardloom.operators.cleaning import clean, deduplicate
from cardloom.plans import validate
from cardloom.plans.prepare import open_prepared, prepare_tables
from cardloom.plans.train import TrainOptions, prepare
from cardloom.schema import KEY
from cardloom.session import object_store_conf
from cardloom.sources.events import load_transactions
from cardloom.sources.snapshots import replace_table
from cardloom.sources.tables import stage
from tests.conftest import SF_SMALL


@pytest.fixture()
def cleaned(spark):
    return stage(clean(load_transactions(spark, SF_SMALL), strict_rules()), "cleaned")


@pytest.fixture()
def tables(spark, cleaned, tmp_path):
    name = f"prepared_{uuid.uuid4().hex}"
    prepare_tables(cleaned, name, TrainOptions(), 4, str(tmp_path / "prepared"))
    return name


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prepared_tables_hold_what_was_prepared(spark, cleaned, tables):
    for named, direct in zip(open_prepared(spark, tables), prepare(cleaned, TrainOptions())):
        assert sorted(named.collect()) == sorted(direct.select(*named.columns).collect())


def test_aggregates_and_joins_by_transaction_need_no_exchange(spark, tables, monkeypatch):
    train, test = open_prepared(spark, tables)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # small tables would be broadcast
    try:
        assert "Exchange" not in executed(deduplicate(train))
        joined = train.join(test.withColumnRenamed("tx_amount", "other"), KEY)
        assert "SortMergeJoin" in executed(joined) and "Exchange" not in executed(joined)
        assert "Exchange" in executed(train.groupBy("customer_id").count())
        assert joined.count() == 0 and deduplicate(train).count() == train.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_validation_from_named_tables_decides_alike(spark, cleaned, tables, tmp_path):
    path = str(tmp_path / "snapshot")
    replace_table(cleaned, path)  # a job finds out by itself that its table is a snapshot table
    decisions = []
    for source, folder in (({"cleaned_path": path}, "a"), ({"cleaned_path": None, "tables": tables}, "b")):
        output = str(tmp_path / folder)
        accepted = validate.run(spark, output=output, **source)
        decisions.append((accepted, sorted((r.model, r.month, r.missed) for r in spark.read.parquet(f"{output}/losses").collect())))
    assert decisions[0] == decisions[1]


def test_committer_settings_are_asked_for_by_name():
    conf = object_store_conf(committer="magic")
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert "spark.sql.sources.commitProtocolClass" in conf
    assert not any("committer" in key for key in object_store_conf())
