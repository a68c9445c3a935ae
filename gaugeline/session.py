"""Session settings the operators rely on, and where intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# UTC makes event dates independent of the machine. The variant setting makes the last of
# two equal JSON keys win instead of rejecting the document, the map setting does so for maps.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # State lies on local disk, and a batch uploads its changes only.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # What is to be forgotten is forgotten with the next messages; no batch runs for it alone.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator assumes. Safe to call repeatedly."""
    for name, value in REQUIRED_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="gaugeline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory for a written intermediate table or a stream checkpoint.

    It lies under ``spark.checkpoint.dir``, which a cluster points at shared storage. Only a
    local session without that setting, where driver and executors share one disk, gets a
    folder of its own, which goes with the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _own_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
