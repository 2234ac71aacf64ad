"""Session settings the warehouse relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job needs; all of them can be changed on a running session.
RUNTIME_CONF = {
    # dt is the UTC calendar day, so the session zone must be UTC everywhere
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a hot join key even where the split costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # INT96 timestamps carry no min/max statistics; micros do, so event_time filters skip row groups
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # keyed state lives on local disk and is logged to the checkpoint folder
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: str | None = None


def build_session(app_name: str = "paystrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the warehouse settings; keyword keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Plan adaptively inside ``foreachBatch``.

    A stream turns adaptive planning off in its own session, because its state must stay where it is. The frame
    handed to ``foreachBatch`` is past the stateful plan, so joins and writes made from it may be re-planned by
    size and skew; the setting goes back before the next micro-batch is planned.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names that folder. Only a local session, where driver and executors share
    one disk, may fall back to a temporary folder.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that every executor can reach")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="paystrata-")
        base = _local_scratch
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
