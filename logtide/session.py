"""Session defaults and the scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Timestamps without a zone mean UTC. Adaptive execution sizes the shuffles and
# splits skewed join and rebalance partitions. Window state lives in RocksDB, outside the heap.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "logtide", **options: str) -> SparkSession:
    """Session with the defaults; master, memory and packages are left to ``spark-submit``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


UTC_NAMES = {"UTC", "Etc/UTC", "Etc/Universal", "Universal", "Zulu", "Z", "GMT", "Etc/GMT", "+00:00", "UTC+00:00"}


def use_utc(spark: SparkSession) -> SparkSession:
    """The session, if it reads zone-less timestamps as UTC. The caller's setting is not changed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone is {zone}; log times are UTC, so set it to UTC")
    return spark


@lru_cache(maxsize=1)
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="run-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Unset, a folder of this process serves where driver and executors are one process
    (master ``local[...]``); elsewhere executors could not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = _own_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
