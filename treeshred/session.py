"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings the jobs rely on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Explodes and typing cost far more than the bytes they read: keep small exchanges parallel.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    # Row assembly aggregates into lists: stay hash based for more keys before sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # The JVM only interprets methods beyond this size; stages that would need one run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "treeshred", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    quiet = {"spark.sql.session.timeZone": "UTC", "spark.python.sql.dataFrameDebugging.enabled": "false"}
    for key, value in {**SETTINGS, **quiet, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets one temporary folder per
    application and any other master is an error: executors would not see
    files of a machine-local folder. The caller's settings are not changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="treeshred-")
        root = _LOCAL_ROOTS[context.applicationId]
    return root.rstrip("/")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder through Spark's own file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, label: str, sort_by: list[str] | None = None) -> DataFrame:
    """Write a frame that several consumers read, and read it back.

    The copy cuts lineage, survives lost executors, and gives Catalyst exact
    sizes, so join strategies below it follow the real size of the data.
    ``sort_by`` clusters rows inside each file for row-group pruning.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return df.sparkSession.read.schema(df.schema).parquet(staged_path(df, label))


def staged_path(df: DataFrame, label: str) -> str:
    """Where a copy of a frame is written."""
    path = f"{staging_root(df.sparkSession)}/stage/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


BROADCAST_ROWS = 200_000


def broadcast_checked(rows: DataFrame) -> DataFrame:
    """A staged table of narrow rows, to be sent around where it has at most BROADCAST_ROWS; beyond that joins shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


PORTION = 16_384  # input rows of a task that explodes: the rows it assembles stay under the fallback threshold above
MOST_PORTIONS = 10_000


def portions_of(*frames: DataFrame) -> int:
    """Number of portions of about PORTION rows that the frames make together, at least one for each core."""
    rows = sum(frame.count() for frame in frames)
    return max(frames[0].sparkSession.sparkContext.defaultParallelism, min(MOST_PORTIONS, -(-rows // PORTION)))


def portioned(rows: DataFrame, *keys: str, like: DataFrame | None = None, portions: int | None = None) -> DataFrame:
    """Deal rows out by key in portions of about PORTION rows, at least one for each core. Where ``like`` has about as many rows
    and costs less, it is counted instead. Frames dealt out in the same number of ``portions`` stay together in their union.

    One input row becomes dozens of nodes, so portions follow the number of rows and not their bytes. Where a later step groups
    by the same key there is nothing left to shuffle.
    """
    return rows.repartition(portions or portions_of(rows if like is None else like), *keys)
