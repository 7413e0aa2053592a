"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

#: Settings every job wants. Anything about size (cores, memory, shuffle
#: partitions) belongs to the cluster, so it is not set here.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Unbounded first-seen state lives in RocksDB on the executors' disks with
    # changelog checkpoints, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_root: str | None = None
_shipped: set[str] = set()


def build_session(app_name: str = "tallyhouse", **overrides: str) -> SparkSession:
    """Get or create a session with :data:`SETTINGS` plus ``overrides``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with the machine.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local_root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path (not yet created) below :func:`shared_root`."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, for the sinks whose
    code runs there; executors need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(), "tallyhouse_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
