"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(master: str = "local[8]", app: str = "tidemill", zone: str = "UTC",
                  shuffle_partitions: int | None = 8, **conf: str) -> SparkSession:
    """A session for local runs and tests; on a cluster the submitter's settings win.

    ``zone`` decides what a calendar day is. Deployments for one country pass its
    zone (for example ``Asia/Shanghai``).
    """
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def state_partitions(spark: SparkSession) -> int:
    """How many parts the state of a stream has: the session's shuffle partitions, but on a
    local master no more than its cores, since every part is a state store to commit."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    context = spark.sparkContext
    return min(wanted, context.defaultParallelism) if context.master.startswith("local") else wanted


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemill-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
