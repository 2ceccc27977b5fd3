from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from cardloom.session import _scratch_root, object_store_conf, remove_scratch, scratch_path, shared_dir, use_scalable_state, use_utc
from cardloom.sources.tables import stage


def test_object_store_settings_hold_only_what_is_given():
    assert object_store_conf() == {"spark.hadoop.fs.s3.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    conf = object_store_conf("https://store.example", "key", "secret", path_style=True)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "https://store.example"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "key"
    assert conf["spark.hadoop.fs.s3a.secret.key"] == "secret"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def session(master, checkpoint=None, configured=None):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else checkpoint,
                              setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_a_cluster_must_name_the_shared_dir():
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("yarn", checkpoint="hdfs:///ck/")) == "hdfs:///ck"
    assert shared_dir(session("yarn", configured="s3a://bucket/ck")) == "s3a://bucket/ck"
    assert "cardloom-" in shared_dir(session("local[4]"))
    with pytest.raises(ValueError):
        shared_dir(session("local-cluster[2,1,1024]"))


def test_scratch_is_removed(spark):
    kept = stage(spark.range(3), "gone")
    folder = Path(_scratch_root(spark).removeprefix("file:"))
    assert kept.count() == 3 and folder.is_dir()
    remove_scratch(spark)
    assert not folder.exists()
    remove_scratch(spark)  # nothing there any more


def test_session_settings(spark):
    use_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    use_scalable_state(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
