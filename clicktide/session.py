"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings for large runs. AQE merges small shuffle partitions, splits skewed
# ones and re-plans joins, so the initial shuffle width may be generous.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Recording the Python call site of every column costs several driver calls each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply what a running session can take of ``CLUSTER_CONF``; the library's one call for its users."""
    for key, value in CLUSTER_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make text-to-timestamp casts and dates independent of the machine's zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_strict(spark: SparkSession) -> SparkSession:
    """Jobs rest on strict casts: a bad date or time is an error, not NULL."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("strict casts are off: call clicktide.session.configure(spark) first")
    return pin_utc(spark)


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``; unset, it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return root


_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("open_scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what ``settle`` wrote inside, once the results are written elsewhere."""
    made: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), made))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in made:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Used where a plan is read several times or holds ids that must not change
    between reads. The written table outlives any executor, and lasts until the
    innermost ``scratch_scope`` ends.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    if scopes := _open_scopes.get():
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
