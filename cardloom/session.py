"""Session settings, object-store settings and the shared scratch folder."""

from __future__ import annotations

import argparse
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Timestamps are compared and bucketed as UTC everywhere. AQE is on by default in
# Spark; its skew and coalescing parts are named here because the plans rely on them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# De-duplication state holds one entry per transaction in the watermark, so it must
# live off-heap and be checkpointed by change log, not by whole snapshots.
STREAM_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def object_store_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    credentials_provider: str | None = None,
    path_style: bool | None = None,
    committer: str | None = None,
) -> dict[str, str]:
    """Spark settings for reading and writing ``s3a://`` and ``s3://`` paths.

    Only the values given are set; with none, the cluster's own credentials chain applies. ``committer``
    names a committer that needs no rename (``magic``, ``directory`` or ``partitioned``); it asks for
    Spark's module for cloud stores on the cluster.
    """
    committing = {
        "spark.hadoop.fs.s3a.committer.name": committer,
        "spark.hadoop.fs.s3a.committer.magic.enabled": "true",
        "spark.sql.sources.commitProtocolClass": "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
        "spark.sql.parquet.output.committer.class": "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
    } if committer else {}
    conf = {
        "spark.hadoop.fs.s3.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.aws.credentials.provider": credentials_provider,
        "spark.hadoop.fs.s3a.path.style.access": None if path_style is None else str(path_style).lower(),
        **committing,
    }
    return {key: value for key, value in conf.items() if value is not None}


def add_store_arguments(parser: argparse.ArgumentParser) -> None:
    """Options of a job for the object store that its paths are in. Keys come from the cluster, never from here."""
    parser.add_argument("--store-endpoint")
    parser.add_argument("--store-credentials", metavar="CLASS", help="provider class of the credentials")
    parser.add_argument("--store-path-style", action="store_true", default=None)
    parser.add_argument("--store-committer", choices=("magic", "directory", "partitioned"))


def store_conf(opts: argparse.Namespace) -> dict[str, str]:
    """The settings that the options of :func:`add_store_arguments` ask for; without any, none."""
    given = dict(endpoint=opts.store_endpoint, credentials_provider=opts.store_credentials,
                 path_style=opts.store_path_style, committer=opts.store_committer)
    return object_store_conf(**given) if any(given.values()) else {}


def build_session(app_name: str, conf: dict[str, str] | None = None, master: str | None = None) -> SparkSession:
    """Get or create a session with the settings the jobs rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **STREAM_STATE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Make sure a session built elsewhere reads and prints timestamps as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_scalable_state(spark: SparkSession) -> SparkSession:
    """Choose the RocksDB state store unless the session already names a provider, whichever it is."""
    if "spark.sql.streaming.stateStore.providerClass" not in spark.conf.getAll:
        for key, value in STREAM_STATE_CONF.items():
            spark.conf.set(key, value)
    return spark


def sibling_session(spark: SparkSession) -> SparkSession:
    """Another session of the same application with the same settings, for work that leaves its mark on a session.

    A session that has run an observation can no longer be serialised, and the functions of a classifier
    that still has its training summary carry their session along: scoring with it would fail.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    return sibling


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):  # not local-cluster, whose executors are processes of their own
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cardloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder.

    All paths of one application share a folder named after it; the jobs remove it when they end.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/cardloom/{spark.sparkContext.applicationId}"


@contextmanager
def job(app_name: str, conf: dict[str, str] | None = None) -> Iterator[SparkSession]:
    """A session for one job. At its end, also a bad one, its scratch paths go and the session stops."""
    spark = build_session(app_name, conf)
    try:
        yield spark
    finally:
        remove_scratch(spark)
        spark.stop()


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has staged; nothing it has staged may be read afterwards."""
    try:
        root = _scratch_root(spark)
    except ValueError:  # no shared folder, so nothing was staged
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
