"""Session settings the operators rely on, and the shared folder jobs write to."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Set only where the session has no value of its own.
DEFAULTS = {
    # RocksDB keeps per-account state off the heap; changelog checkpoints upload only what changed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Merge the sessions of a busy account inside each input partition before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC and fill in the defaults above."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="ledgerstream-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A local session without the setting gets a temporary folder; a cluster without it is an error,
    because a folder of one machine is lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_dir()
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one, for a single run of ``name``."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
