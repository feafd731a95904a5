"""Session settings the operators rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings every pipeline needs: instants are handled in UTC, adaptive execution re-plans joins from
# measured sizes and splits the partitions of hot keys (also when that costs one more exchange).
# Where every measured partition of a side is within 64 MB, the join hashes it instead of sorting both
# sides; the joined sides here are aggregates with one row per key, so no hash table grows with skew.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings of :data:`REQUIRED` to a running session."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session (tests) falls back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="brisa-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


# Folders that write_out made and values that share sent inside scratch(), innermost last.
_owned: list[list[str | Broadcast]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what :func:`write_out` writes and :func:`share` sends meanwhile; results must have been stored by then.

    What is written with ``kept`` outlives the innermost ``scratch``; the one around it, if any, removes it.
    """
    _owned.append([])
    try:
        yield
    finally:
        for held in _owned.pop():
            if isinstance(held, Broadcast):
                held.destroy()
                continue
            folder = spark._jvm.org.apache.hadoop.fs.Path(held)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def share(spark: SparkSession, value: T) -> Broadcast[T]:
    """Send a value of bounded size to every executor."""
    sent = spark.sparkContext.broadcast(value)
    if _owned:
        _owned[-1].append(sent)
    return sent


def write_out(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result must be fixed before it is read twice: the written table cuts the lineage, so
    a lost executor costs a re-read and never a recomputation that could come out in another order.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    owners = _owned[:-1] if kept else _owned
    if owners:
        owners[-1].append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
