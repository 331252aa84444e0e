"""Session settings and the shared folder used for checkpoints and stream output."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sitecorpus")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on, and the bytes of an Arrow batch, of which a Python worker and its task
    hold two or three at once; all are per-session SQL settings."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; with a local master and none configured (tests), a temporary one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, visible to every executor."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise on reliable storage and drop the lineage (iterative jobs)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_open: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that `stage` writes inside are deleted at the end, but for those it is told to keep."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open.remove(paths)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table several later steps read, to the shared folder, and read it back.

    Survives executor loss, computes its input once, and gives the optimizer real sizes for join choices. `keep` lets it
    outlast a `temporary` block around.
    """
    path = scratch_path(df.sparkSession, name)
    if _open and not keep:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
