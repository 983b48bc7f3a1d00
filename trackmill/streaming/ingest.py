"""Process only the sample files that have not been processed yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.operators.slices import Series
from trackmill.sources.tables import write_daily


def incremental_ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType,
                       process: Callable[[DataFrame], DataFrame], s: Series, overwrite: bool = False,
                       files_per_batch: int | None = None) -> DataFrame:
    """Run ``process`` over the new files under ``source`` and add the result to ``target``.

    A file source with a checkpoint remembers what was read, so a second run does nothing and an
    aborted one resumes.  Each micro-batch writes its own ``ingest_batch`` partition and
    replaces it when repeated, which makes the at-least-once batches take effect once.
    A file is expected to hold whole flights.

    ``overwrite`` starts over: it builds a new target beside the old one under a new checkpoint, and only when that has succeeded do
    both become the current ones, for this and all later runs.  A run that finds a switch half done completes it.
    """
    files = _Files(spark)
    current, fresh = files.current(checkpoint), f"{target.rstrip('/')}.next"
    files.finish_switch(checkpoint, current, target, fresh)
    if overwrite:
        current += 1
        files.delete(f"{checkpoint}/v{current}")
        files.delete(fresh)
        _run(spark, source, fresh, f"{checkpoint}/v{current}", schema, process, s, files_per_batch)
        if not files.exists(fresh):
            process(spark.createDataFrame([], schema)).limit(0).write.parquet(fresh)
        files.create(f"{checkpoint}/current-{current}")
        files.finish_switch(checkpoint, current, target, fresh)
    else:
        _run(spark, source, target, f"{checkpoint}/v{current}", schema, process, s, files_per_batch)
    return spark.read.parquet(target)


class _Files:
    """The few calls on the cluster's file system that a switch needs."""

    def __init__(self, spark: SparkSession):
        self.path, self.conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        path = self.path(name)
        return path.getFileSystem(self.conf), path

    def exists(self, name: str) -> bool:
        store, path = self._at(name)
        return store.exists(path)

    def delete(self, name: str) -> None:
        store, path = self._at(name)
        store.delete(path, True)

    def create(self, name: str) -> None:
        store, path = self._at(name)
        store.create(path, True).close()

    def current(self, checkpoint: str) -> int:
        """Number of the checkpoint in force: the highest with a mark, 0 without any."""
        store, path = self._at(checkpoint)
        names = [f.getPath().getName() for f in store.listStatus(path)] if store.exists(path) else []
        return max((int(n.removeprefix("current-")) for n in names if n.startswith("current-")), default=0)

    def rename(self, name: str, to: str) -> None:
        """Move a folder; a file system that reports failure by its result raises as well."""
        store, path = self._at(name)
        if not store.rename(path, self.path(to)):
            raise OSError(f"could not rename {name} to {to}")

    def finish_switch(self, checkpoint: str, current: int, target: str, fresh: str) -> None:
        """Put a finished new target in place of the old one; an unmarked one belongs to a run that failed.

        The old target keeps another name until the new one is in place, and comes back where that fails.
        """
        if self.exists(f"{checkpoint}/current-{current}") and not self.exists(f"{checkpoint}/switched-{current}"):
            old = f"{target.rstrip('/')}.old"
            if self.exists(fresh):
                if self.exists(target):
                    self.delete(old)
                    self.rename(target, old)
                try:
                    self.rename(fresh, target)
                except Exception:
                    if self.exists(old) and not self.exists(target):
                        self.rename(old, target)
                    raise
            self.create(f"{checkpoint}/switched-{current}")
            self.delete(old)


def _run(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType, process: Callable[[DataFrame], DataFrame],
         s: Series, files_per_batch: int | None) -> None:
    """One stream over the files that the checkpoint does not know yet."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        done = process(batch).withColumn("ingest_batch", F.lit(batch_id))
        write_daily(done, target, s, also=["ingest_batch"])

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(source).writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
