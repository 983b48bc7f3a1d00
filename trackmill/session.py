"""Session helpers: a local session for tests and benches, shared scratch space, materialised stages."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class _Open(threading.local):
    """Stages that a thread has written since it began a ``settled`` one; ``None`` outside of any."""

    paths: list[str] | None = None


_open = _Open()


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and benches.  On a cluster the caller brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trackmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written stages.

    A cluster names it in ``spark.checkpoint.dir``.  Only where that is unset, in local mode, it is a folder of the
    warehouse, which is shared as well; it is then set on the context.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/trackmill-stages")
        current = context.getCheckpointDir()
    return current.rstrip("/")


def stage_root(spark: SparkSession) -> str:
    """Where this application keeps its written stages."""
    return f"{shared_dir(spark)}/trackmill/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet under the shared folder."""
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_stage(spark: SparkSession, path: str) -> bool:
    """Delete one path of ``fresh_path`` that nothing reads any more."""
    if not path.startswith(f"{stage_root(spark)}/"):
        raise ValueError(f"not a stage of this application: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_stages(spark: SparkSession) -> bool:
    """Delete the stages this application has written.  Frames read from them become unusable."""
    path = spark._jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and, unlike a checkpoint, keeps column
    pruning and filter pushdown for every later read.  Used where a flow reads one expensive
    frame several times.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    if _open.paths is not None:
        _open.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the driver's JVM collect what is out of use, so that Spark deletes the shuffle files of stages that are written.

    What the first collection finds is let go of by Spark's cleaner, which frees the rest for the second.
    """
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def settled(build: Callable[[], DataFrame], label: str = "stage") -> DataFrame:
    """``materialise`` what ``build`` returns, then delete the stages that this thread wrote while it was built.

    So a flow of several written stages holds the last one only, and not all of them at once.  Nothing but the result of ``build`` may
    read what ``build`` has written.
    """
    outer, _open.paths = _open.paths, []
    try:
        df = build()
        spark, done = df.sparkSession, _open.paths
        _open.paths = outer
        out = materialise(df, label)
    finally:
        _open.paths = outer
    del df
    for path in done:
        drop_stage(spark, path)
    release(spark)
    return out
