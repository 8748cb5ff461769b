"""Session settings for local runs, and the shared folder of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", app: str = "millwatch", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster, use the session it provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a session within one process may run without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="millwatch-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Stateful processors keep their state in RocksDB, on disk, not on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
