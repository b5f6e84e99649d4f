"""Session helpers: a local session for tests/bench and the shared scratch root.

On a cluster the session comes from ``spark-submit``; these helpers only
fill settings that are unset, and never point at a machine-local folder
unless the session names none (tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from devpulse import constants as C

STATE_STORE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MIN_BATCHES_TO_RETAIN = "spark.sql.streaming.minBatchesToRetain"

# Settings every devpulse job relies on. Time-zone pinning makes
# ``to_date`` and the NTZ <-> TIMESTAMP casts deterministic.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "devpulse") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config(MIN_BATCHES_TO_RETAIN, str(C.MIN_BATCHES_TO_RETAIN))
    )
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (runtime setting, no restart)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_defaults(spark: SparkSession) -> SparkSession:
    """Keep streaming state in RocksDB (off the JVM heap, spills to local
    disk, changelog checkpoints) unless the session names a provider, and
    keep 10 micro-batches of checkpoint history unless set.

    Only a new checkpoint takes this setting: the provider is recorded in
    the checkpoint, and a restarted query keeps the one it started with.
    """
    conf = spark._jsparkSession.conf()
    if not conf.contains(STATE_STORE_PROVIDER):
        spark.conf.set(STATE_STORE_PROVIDER, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    if not conf.contains(MIN_BATCHES_TO_RETAIN):
        spark.conf.set(MIN_BATCHES_TO_RETAIN, str(C.MIN_BATCHES_TO_RETAIN))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir`` (what the cluster names). Only a local
    session (tests, local runs) that names none gets a folder created here;
    on a cluster a machine-local folder would not be shared by the executors,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    registered = sc._jsc.sc().getCheckpointDir()
    if not root and registered.isDefined():
        root = registered.get()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder all executors share "
                               "(it holds staged tables and streaming checkpoints)")
        root = tempfile.mkdtemp(prefix="devpulse-ckpt-")
    if not registered.isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
