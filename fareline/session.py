"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# UTC makes offset-less and offset-carrying timestamps agree. The rest lets Spark
# re-plan at run time: split skewed partitions, coalesce small ones, and choose a
# broadcast only from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes. The wide ride stages exceed that
    # when fused into one, so let Spark run those operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables of ride payloads take half the room that Spark's default, snappy, gives them.
    "spark.sql.parquet.compression.codec": "zstd",
}

# Dedup state lives in RocksDB, off the executor heap.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Whether the shuffle files of a query go as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int = 8, app: str = "fareline", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        # Recording the call site of every column costs more than small plans do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**SETTINGS, **STATE_STORE}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def no_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of a query go when it has ended.

    By itself Spark drops them with the driver's garbage, which a driver with memory to spare
    may not collect for half an hour, while each hop adds files as large as its rows. A
    DataFrame that is run again meanwhile shuffles again.
    """
    usual = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if usual is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, usual)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session may fall back to a folder of this machine.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="fareline-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
