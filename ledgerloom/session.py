"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot key's partition is worth another exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State of streams lives on disk with an index in memory, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_base: dict[str, str] = {}
_collecting: list[list[str]] = []


def build_session(master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the library is tested under."""
    builder = SparkSession.builder.appName("ledgerloom")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings that fit a job to its input and cluster.

    Shuffle partitions of about 200 MB, at least three waves of tasks, and scan
    splits that grow from 128 MB to 512 MB so that a 100 TB scan stays near
    200,000 tasks. Adaptive execution joins what turns out too small.
    """
    split = min(max(input_bytes // (cores * 50), 128 << 20), 512 << 20)
    shuffle = max(3 * cores, math.ceil(input_bytes / (200 << 20)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(min(shuffle, 100_000)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(200 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under the folder that ``spark.checkpoint.dir`` names. Where that is
    unset, a temporary folder serves local sessions; a cluster session is
    refused, since its executors do not see the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _local_base.setdefault(app, tempfile.mkdtemp(prefix="run-"))
    path = f"{base.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}/{purpose}"
    for made in _collecting:
        made.append(path)
    return path


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The shared folders that are made inside the block, for ``release`` once nothing reads them."""
    made: list[str] = []
    _collecting.append(made)
    try:
        yield made
    finally:
        # By identity: equal lists are not the same one.
        _collecting[:] = [m for m in _collecting if m is not made]


def release(spark: SparkSession, folders: list[str]) -> None:
    """Remove shared folders of this module, and shuffle files that no DataFrame can reach any more.

    Call it when what was computed from the folders is itself stored: a lost
    executor then costs a re-read of that, and nothing asks for the folders again.
    Spark drops shuffle files once the driver's JVM has collected their owners,
    so it is asked to do that now.
    """
    for folder in folders:
        if "/ledgerloom-" not in folder:
            raise ValueError(f"not a folder made by shared_folder: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder.rsplit("/", 1)[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back.

    Cuts the lineage: readers no longer repeat the work, a lost executor costs
    a re-read only, and Spark knows the real size.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.mode("errorifexists").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
