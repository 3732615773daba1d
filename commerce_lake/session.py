"""Session defaults and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


def build_session(app: str = "commerce_lake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Shuffle width and split size are left to the cluster's own configuration
    unless given; AQE coalesces small shuffles and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        _STATE_PROVIDER_CONF: ROCKSDB_PROVIDER,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: stored timestamps are dated in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir.

    Where that is unset, below the session's warehouse folder, which executors share as well.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


class rocksdb_state:
    """Run streaming starts inside the block on the RocksDB state store.

    The provider is read when a query starts, so the session's own setting can
    be put back afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> SparkSession:
        self.before = self.spark.conf.get(_STATE_PROVIDER_CONF, None)
        self.spark.conf.set(_STATE_PROVIDER_CONF, ROCKSDB_PROVIDER)
        return self.spark

    def __exit__(self, *exc) -> None:
        if self.before is None:
            self.spark.conf.unset(_STATE_PROVIDER_CONF)
        else:
            self.spark.conf.set(_STATE_PROVIDER_CONF, self.before)
