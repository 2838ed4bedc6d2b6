"""Session settings and the shared working folder.

``configure`` only touches runtime SQL settings, so it is safe to call on a
session someone else built (the driver's, a notebook's, a cluster job's).
Cluster-sized knobs such as ``spark.sql.shuffle.partitions`` are left to the
caller; ``build_session`` sets them for local runs and tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job in this package relies on.
#  * UTC: zone-less transaction_time text is read in the session zone and the
#    producers write UTC.
#  * AQE with skew-join splitting: a hot user / window key is split at run
#    time instead of landing in one task; small join sides found at run time
#    become broadcasts.
#  * Runtime bloom filters where Spark can build them (filtered scans on the
#    small side of a shuffle join).
#  Partition overwrite mode is not set session-wide: writers here pass
#  ``partitionOverwriteMode=dynamic`` per write, other writes keep theirs.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # RocksDB keeps streaming state off the JVM heap; it is read when a query
    # starts for the first time on a checkpoint, so it must be set up front.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit only the changes of a micro-batch; snapshots are made in the background
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this package needs to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[*]",
    app: str = "txnguard",
    shuffle_partitions: int | None = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or get) a session for local runs and tests."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TXNGUARD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session has none (tests, ad-hoc runs) do we pick our own
    folder, and we register it so ``DataFrame.checkpoint()`` works too. On a
    cluster a machine-local folder would not be shared, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="txnguard-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder for tables and stream state."""
    segs = [checkpoint_root(spark), "txnguard", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(segs)
