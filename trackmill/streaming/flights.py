"""Flights whose samples come in several deliveries: put together by keyed state, closed by event time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trackmill.functions.timing import micros
from trackmill.operators.slices import Series
from trackmill.sources.tables import write_daily

LATE = "_late"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows that are handed out at a time when a flight closes.
HANDED = 10_000


class FlightState(StatefulProcessor):
    """Holds the samples of open flights; a flight closes when the watermark is ``gap_ms`` past its last sample.

    Input is a key, ``ms`` (the sample's time, rounded up) and ``sample`` as text, which state takes as it is.  State of a flight is its
    samples, read back from the store in pieces, and the time of its last one.  A sample is late if it comes
    when its flight is not open and would already have been closed; one without a time is late always.
    """

    def __init__(self, gap_ms: int):
        self.gap = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "sample string")
        self.last = handle.getValueState("last", "ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if key[0] is None:  # a heartbeat
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        last = self.last.get()[0] if self.last.exists() else None
        newest = last
        for batch in rows:
            ms = batch["ms"].astype("Float64")
            late = ms.isna() if last is not None else ms.isna() | (ms + self.gap <= watermark).fillna(True)
            late = late.to_numpy(dtype=bool)
            if late.any():
                yield pd.DataFrame({"sample": batch["sample"][late], LATE: True})
            if not late.all():
                self.rows.appendList([(r,) for r in batch["sample"][~late]])
                newest = max(int(ms[~late].max()), newest if newest is not None else 0)
        if newest != last:
            if last is not None:
                self.handle.deleteTimer(last + self.gap)
            self.handle.registerTimer(newest + self.gap)
            self.last.update((newest,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        samples = self.rows.get()
        while held := [r[0] for r in islice(samples, HANDED)]:
            yield pd.DataFrame({"sample": held, LATE: False})
        self.rows.clear()
        self.last.clear()

    def close(self) -> None:
        pass


@contextmanager
def _state_store(spark: SparkSession):
    """Timers and list state need the RocksDB state store; the setting is put back."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def whole_flights(stream: DataFrame, s: Series, gap_s: float, delay_s: float) -> DataFrame:
    """The samples of a stream, each when its flight is complete, with ``LATE`` true for those that came too late.

    The watermark trails the latest sample by ``delay_s``; a flight is complete when the watermark is ``gap_s`` past its last sample.  What comes
    later under its id is late, unless it is itself later than that: then it is a further flight of that id.  A row without an
    id moves the watermark on and is dropped.
    """
    times = [f.name for f in stream.schema if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    plain = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in stream.schema])
    # The watermark stands on a copy of the time which is dropped before the state, as Spark would drop late rows itself.
    marked = stream.withColumn("_clock", F.col(s.time).cast("timestamp")).withWatermark("_clock", f"{round(delay_s * 1000)} milliseconds").drop("_clock")
    sample = F.struct(*[micros(c).alias(c) if c in times else F.col(c) for c in stream.columns])
    packed = marked.select(F.col(s.key).cast("string").alias("flight"), F.ceil(micros(s.time) / 1000).alias("ms"), F.to_json(sample).alias("sample"))
    whole = packed.groupBy("flight").transformWithStateInPandas(
        FlightState(round(gap_s * 1000)), f"sample string, {LATE} boolean", "append", "eventTime")
    read = whole.select(F.from_json("sample", plain).alias("sample"), LATE)
    kinds = {f.name: f.dataType for f in stream.schema}
    return read.select(*[F.timestamp_micros(f"sample.{c}").cast(kinds[c]).alias(c) if c in times else F.col(f"sample.{c}").alias(c)
                         for c in stream.columns], LATE)


def ingest_flights(spark: SparkSession, source: str, target: str, late: str, checkpoint: str, schema: T.StructType,
                   process: Callable[[DataFrame], DataFrame], s: Series, gap_s: float, delay_s: float = 0.0,
                   files_per_batch: int | None = None) -> None:
    """Run ``process`` over whole flights from the new files under ``source``, whichever files their samples lie in.

    Each micro-batch adds the flights that have become complete to ``target`` and the samples that came too late to ``late``, in a partition of its
    own (``ingest_batch``) which it replaces when repeated, so that batches take effect once.  Open flights stay in the state for
    the next run.  State is bounded by what was heard during the last ``gap_s + delay_s`` seconds and of flights still in the air.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("ingest_batch", F.lit(batch_id)).persist()
        try:
            done = process(numbered.filter(~F.col(LATE)).drop(LATE, "ingest_batch"))
            write_daily(done.withColumn("ingest_batch", F.lit(batch_id)), target, s, also=["ingest_batch"])
            (numbered.filter(LATE).drop(LATE).write.partitionBy("ingest_batch").mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").parquet(late))
        finally:
            numbered.unpersist()

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    with _state_store(spark):
        query = (whole_flights(reader.parquet(source), s, gap_s, delay_s).writeStream.foreachBatch(one_batch)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
